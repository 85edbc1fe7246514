"""Scans and sinks: JSON lines, JSON arrays, page files, manifest and export CSV, raw tables."""
