"""Structured Streaming: arriving readings into the table, live scoring."""
