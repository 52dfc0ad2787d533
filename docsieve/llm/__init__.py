"""Operators for preparing training text: archives, mixing, fingerprints, deduplication, sharding, packing, quality."""
