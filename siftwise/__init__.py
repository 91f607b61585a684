"""Content deduplication, keyed-table maintenance and vector similarity on Spark DataFrames."""

__version__ = "0.1.0"
