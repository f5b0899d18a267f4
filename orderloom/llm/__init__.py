"""Operators that prepare training text: deduplication, extraction, cleaning, scoring, packing, sharding."""
