"""Rule-violation analytics on Spark DataFrames."""
