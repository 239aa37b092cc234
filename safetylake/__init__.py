"""Drug-safety analytics on Spark DataFrames."""
