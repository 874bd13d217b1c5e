"""Structured Streaming source and sink wiring."""
