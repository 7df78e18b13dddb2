"""tradevault: trade-lifecycle analytics on Spark DataFrames."""
