"""Streams: windows over event time, deduplication with state, incremental funnels."""
