"""Readers of landed files."""
