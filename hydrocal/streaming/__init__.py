"""Structured Streaming form of the daily keep-first and barometer join."""
