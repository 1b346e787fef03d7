"""Readers of semi-structured sources; each file or row is parsed by one task, files in parallel."""
