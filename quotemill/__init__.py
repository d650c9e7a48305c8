"""Price, quote and volume time series on PySpark DataFrames."""

__version__ = "0.1.0"
