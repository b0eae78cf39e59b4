"""Whole runs: load a directory, convert, build entities, publish."""
