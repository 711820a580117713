"""Corpus indexing and hybrid search over many source repositories, on Spark."""
