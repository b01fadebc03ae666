"""Incremental consolidation of newly arriving publications."""
