"""Corpus curation and label evaluation on Spark DataFrames."""
