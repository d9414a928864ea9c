"""Retail order processing and star-schema analytics as Spark jobs."""
