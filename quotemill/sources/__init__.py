"""Readers for raw files and written tables."""
