"""linkloom: record linkage, text retrieval and evaluation on Spark DataFrames."""
