"""Streaming: intentionally empty.

The reference reads whole files or single HTTP responses; it has no stream
source, watermark, event-time window, state or late-data handling, so no
Structured Streaming operator is built here (see README, "Not built").
"""
