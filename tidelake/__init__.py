"""tidelake: incremental loads into a parquet lake, and proof that they are right, on Spark DataFrames."""

__version__ = "0.1.0"
