"""Incremental market-feed analytics built from Spark DataFrame, SQL and Structured Streaming."""
