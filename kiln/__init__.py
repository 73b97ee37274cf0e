"""kiln: relational feature analytics on Spark DataFrames."""
