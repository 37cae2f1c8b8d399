"""Tidemark: record discovery, normalisation and entity resolution on Spark DataFrames."""
