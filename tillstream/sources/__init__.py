"""Readers: message topics, raw log lines, dimension and day tables."""
