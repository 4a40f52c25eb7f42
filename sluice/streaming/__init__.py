"""Continuous loads with Structured Streaming."""
