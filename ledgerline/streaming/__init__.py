"""Structured Streaming sources of the pipeline."""
