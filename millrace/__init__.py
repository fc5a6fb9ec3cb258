"""Millrace: DataFrame operators for ingestion, quality, time series and retrieval on Spark."""
