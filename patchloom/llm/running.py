"""Running totals in a global order, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.session import materialised


def running_totals(rows: DataFrame, group: str, order: Sequence[Column], amount: str, total: str) -> DataFrame:
    """``rows`` with ``total``: the sum of ``amount`` over the rows of the same group that come before.

    Rows are range-partitioned by group and order, so a group of any size is spread over partitions; each partition
    sums its rows of a group, the sums (one row per group and partition) run up over the partitions, and rows run up inside
    their own. ``group`` holds no nulls. Rows alike in all of ``order`` come in any order.
    An empty table gives an empty table. ``rows`` should be a stored table: it is read twice, once to find the ranges.
    """
    placed = materialised(
        rows.repartitionByRange(F.col(group), *order).withColumn("part", F.spark_partition_id()), "ranged")
    up_to = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        placed.groupBy(group, "part").agg(F.sum(amount).alias("own"))
        .select(group, "part", F.coalesce(F.sum("own").over(up_to), F.lit(0)).alias("earlier"))
    )
    inside = Window.partitionBy(group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(earlier, [group, "part"])
        .withColumn(total, F.col("earlier") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("part", "earlier")
    )
