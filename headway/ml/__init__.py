"""Delay classification."""
