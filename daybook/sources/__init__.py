"""Readers of the landed files, each with a declared schema."""
