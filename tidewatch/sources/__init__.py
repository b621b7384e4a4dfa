"""Scans and sinks: driver tables, panels built from them, files."""
