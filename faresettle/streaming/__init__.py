"""Incremental loading of dropped files."""
