"""Composed plans: the full validation and the registered demonstration queries."""
