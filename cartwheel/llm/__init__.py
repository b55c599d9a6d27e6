"""Operators for preparing training text: deduplication, filtering, mixing, sharding, audits and
scoring. Nothing else in the library imports this package."""
