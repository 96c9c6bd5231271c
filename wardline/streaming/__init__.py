"""Incremental loads driven by new landing files."""
