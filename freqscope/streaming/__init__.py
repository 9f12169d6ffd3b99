"""Structured Streaming jobs (ST1-ST6)."""
