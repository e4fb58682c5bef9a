"""Whole runs, composed of the table operators."""
