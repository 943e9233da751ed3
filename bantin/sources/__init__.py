"""Readers, writers and tables."""
