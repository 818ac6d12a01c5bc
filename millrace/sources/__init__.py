"""Readers, writers, seed dimensions and the mapping of the sample tables."""
