"""Report sinks."""
