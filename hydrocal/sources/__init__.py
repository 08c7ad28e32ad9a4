"""Sources: CSV folders, configuration JSON, HTML tables and stand-ins over driver tables."""
