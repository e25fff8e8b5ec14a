"""Opinion analytics over large comment tables, written for Spark DataFrames."""

__version__ = "0.1.0"
