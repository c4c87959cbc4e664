"""Star-schema loading and lookup tables for event logs, on Spark DataFrames."""

__version__ = "0.1.0"
