"""Incremental pipelines: raw -> parsed -> chunks, and chunks -> index."""
