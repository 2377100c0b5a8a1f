"""Whole tasks composed of operators: search, build, merge, ingest."""
