"""lexiflow: spelling-correction data preparation, labelling and scoring on Spark."""

__version__ = "0.1.0"
