"""Scans, sinks and content lookups."""
