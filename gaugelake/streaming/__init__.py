"""Structured Streaming legs over landed pulls."""
