"""Workflows over written tables."""
