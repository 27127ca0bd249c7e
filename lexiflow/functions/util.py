"""Helpers for higher-order Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda variable.

    A Column used inside a lambda is re-evaluated on every call of that lambda;
    binding it first keeps array-heavy expressions linear.
    """
    return F.get(F.transform(F.array(value), body), 0)
