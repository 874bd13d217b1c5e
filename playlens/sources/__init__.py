"""Readers, writers, message coding and the mapping of the sample tables."""
