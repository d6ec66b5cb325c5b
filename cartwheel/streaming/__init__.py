"""Structured Streaming variants of the landing stage."""
