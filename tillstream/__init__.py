"""Retail streaming warehouse as Spark DataFrame functions and Structured Streaming jobs."""
