"""Audience-overlap analytics over tagged posts, on Spark DataFrames."""
