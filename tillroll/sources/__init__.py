"""Readers of the driver tables and file sources / sinks."""
