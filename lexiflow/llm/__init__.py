"""Operators of a training-data pipeline (optional subpackage)."""
