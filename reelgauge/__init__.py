"""reelgauge: audience-comment analytics on Spark DataFrames."""
