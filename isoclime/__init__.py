"""Anomaly and risk marts over large collections of daily and hourly series, as Spark jobs."""
