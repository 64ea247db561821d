"""Operators on text corpora: packing, counting, extracting, scoring, filtering, deduplicating."""
