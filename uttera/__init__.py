"""Uttera: utterance-dataset operators expressed on Spark DataFrames."""
