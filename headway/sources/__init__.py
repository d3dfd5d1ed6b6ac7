"""Readers, feeds and stored tables."""
