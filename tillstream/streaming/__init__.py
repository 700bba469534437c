"""Structured Streaming: sinks that survive replays, and the three jobs."""
