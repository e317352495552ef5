"""A lexicon engine on Spark DataFrames."""
