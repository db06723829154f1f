"""Application-log analytics on Spark DataFrames."""
