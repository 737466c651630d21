"""Spark-first analytics over satellite detection streams and text corpora."""
