"""Counts over a run."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageCounts:
    """What the stages of a run take in and give out, counted while their tables are written.

    ``seen`` hangs counts on a table; they are there once an action (the write of the stage's one table, good and failed rows alike) has
    read it, so no stage is read a second time for its numbers. Each observed table should be read by one action: an action that
    computes it twice counts twice.
    """

    COUNTS = ["loaded", "bad", "written", "failed"]

    def __init__(self) -> None:
        self._stages: dict[str, list[Observation]] = {}

    def seen(self, stage: str, rows: DataFrame, **conditions: Column) -> DataFrame:
        """``rows`` unchanged; for every count (``loaded``, ``bad``, ``written``, ``failed``) the rows that meet its condition."""
        observation = Observation(f"{stage}-{uuid.uuid4().hex}")
        self._stages.setdefault(stage, []).append(observation)
        return rows.observe(observation, *[F.count(F.when(c, 1)).alias(name) for name, c in conditions.items()])

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per stage: stage, loaded, bad, written, failed. Waits for stages whose table is still being written."""
        rows = [(stage, *[sum(o.get.get(name, 0) for o in found) for name in self.COUNTS]) for stage, found in self._stages.items()]
        return spark.createDataFrame(rows, "stage string, " + ", ".join(f"{name} bigint" for name in self.COUNTS))


def run_summary(results: DataFrame) -> DataFrame:
    """Outcome per repository from result rows (org, repo, return_code): failed when any code is not 0.

    The row with null org and repo holds the totals.
    """
    per_repo = results.groupBy("org", "repo").agg(
        F.max(F.when(F.col("return_code") != 0, 1).otherwise(0)).alias("failed")
    )
    return per_repo.groupingSets([("org", "repo"), ()], "org", "repo").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("failed") == 0).alias("success"),
        F.count_if(F.col("failed") == 1).alias("failures"),
    ).select("org", "repo", "total", "success", "failures")
