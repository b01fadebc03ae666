"""Readers and fixture bridges."""
