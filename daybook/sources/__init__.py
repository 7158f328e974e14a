"""Readers of landed files, reference lists and named tables."""
