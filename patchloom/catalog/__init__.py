"""Registered queries: every operator over the driver tables, with its SQL twin."""

from patchloom.catalog import assembly, changes, scans, selections, texts  # noqa: F401
from patchloom.catalog.registry import QUERIES, TWINS, Tables

__all__ = ["QUERIES", "TWINS", "Tables"]
