"""Sinks and query control for Structured Streaming."""
