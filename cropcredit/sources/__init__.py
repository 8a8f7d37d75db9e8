"""Data sources and sinks."""
