"""Operators of a large-scale training-data pipeline (deduplication, filtering, extraction, mixing, search)."""
