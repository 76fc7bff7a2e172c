"""Structured Streaming: sessions, sinks, progress and the jobs."""
