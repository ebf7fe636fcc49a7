"""Entity-level activity and retention analytics on Spark DataFrames."""
