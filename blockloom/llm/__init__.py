"""Operators for large training corpora: filtering, deduplication, packing, output."""
