"""Incremental processing of files as they land."""
