"""Readers, writers and the layout of stored tables."""
