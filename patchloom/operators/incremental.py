"""Runs that add only what is not there yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.operators.pulls import dedup_last_wins


def resume_anti(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the earlier output."""
    return rows.join(done.select(*keys), keys, "left_anti")


def refresh_latest(done: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Earlier output and new rows in one, the newest row per key kept.

    ``resume_anti`` never refreshes a key that is already there; this does.
    """
    return dedup_last_wins(done.unionByName(rows), keys, order)


def unexamined(rows: DataFrame, ledger: DataFrame, keys: list[str], version: Column) -> DataFrame:
    """Rows that no ledger row (keys, ``version``) names as they are now: new ones, and those whose version has changed since.

    The versions of a key meet its rows as one row, so that the join is on the keys alone: rows that stay are where a later join on them wants them.
    """
    known = ledger.groupBy(*keys).agg(F.collect_set("version").alias("_versions"))
    seen = F.coalesce(F.array_contains("_versions", F.col("_version")), F.lit(False))
    return rows.withColumn("_version", version).join(known, keys, "left").filter(~seen).drop("_version", "_versions")
