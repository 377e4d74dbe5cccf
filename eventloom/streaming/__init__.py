"""Structured Streaming jobs and time-window alerts."""
