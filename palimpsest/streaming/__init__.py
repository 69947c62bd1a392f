"""Structured Streaming around the merges."""
