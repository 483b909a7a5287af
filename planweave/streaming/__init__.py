"""Streams of decisions, events and measurements."""
