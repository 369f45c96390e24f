"""Operators for large training corpora: extraction, dedup, filtering, mixing, packing, encoding."""
