"""Operators for building training data: scoring, archives, filters, near duplicates, mixing, token files."""
