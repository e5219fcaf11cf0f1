"""Structured Streaming forms of the recent-orders and latest-scan tables."""
