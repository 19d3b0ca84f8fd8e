"""Time-stamped ledger and price analytics on Spark DataFrames."""

__version__ = "0.1.0"
