"""Readers for the landing directory and the lake tables."""
