"""Structured Streaming: scoring, severity alerts, signal alerts, counters."""
