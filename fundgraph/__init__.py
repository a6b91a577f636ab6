"""Fund/provider graph analytics on Spark DataFrames."""
