"""Relational operators of the validation (joins, keep-first, gaps, depth, quality)."""
