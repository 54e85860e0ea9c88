"""Structured Streaming forms of the lifecycle, billing and demand operators."""
