"""spoolweave: transcript alignment, fusion and text processing on Spark DataFrames."""

__version__ = "0.1.0"
