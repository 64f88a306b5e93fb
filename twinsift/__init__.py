"""twinsift: finding and removing duplicate data with Spark DataFrames."""

__version__ = "0.1.0"
