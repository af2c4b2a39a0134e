"""Analytics over recorded speech and large text corpora, on Spark DataFrames."""
