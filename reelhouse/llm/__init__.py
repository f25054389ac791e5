"""Operators of a training-data pipeline: deduplication, search, mixing, packing, token stores, scoring and licences."""
