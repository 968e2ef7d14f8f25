"""Streams: scoring of arriving files, counts of events by window."""
