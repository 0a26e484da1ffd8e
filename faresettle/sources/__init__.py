"""Readers: databases, window-named files, JSON payloads."""
