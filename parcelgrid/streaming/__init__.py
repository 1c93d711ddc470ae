"""Structured Streaming variants of the batch pipelines."""
