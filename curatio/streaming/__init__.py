"""Structured Streaming intake and cross-batch dedup."""
