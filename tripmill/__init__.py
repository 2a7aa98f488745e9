"""Trip analytics on Spark DataFrames: quality split, enrichment, marts, serving queries, run history."""
