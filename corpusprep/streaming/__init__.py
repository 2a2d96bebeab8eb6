"""Incremental runs over new files."""
