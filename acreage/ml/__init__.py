"""Spark ML stages and training jobs."""
