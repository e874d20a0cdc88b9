"""Structured Streaming jobs over log lines and message envelopes."""
