"""Scans of landed files, listings, configuration tables and sinks."""
