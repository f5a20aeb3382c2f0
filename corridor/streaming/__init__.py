"""Structured Streaming sinks and jobs."""
