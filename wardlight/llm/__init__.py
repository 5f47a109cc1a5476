"""Operators for preparing training text: scoring, cleaning, deduplication, encoding, packing and search."""
