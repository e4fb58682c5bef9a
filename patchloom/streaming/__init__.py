"""Streaming forms of the incremental rules."""
