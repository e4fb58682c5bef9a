"""Readers and writers of the landed tables."""
