"""Scheduled jobs as Structured Streaming queries."""
