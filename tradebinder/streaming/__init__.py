"""Incremental loading of newly archived files."""
