"""Operators for preparing training data: search, scoring, deduplication, filtering, encoding."""
