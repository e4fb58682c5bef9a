"""Scores of predicted bug ranges against known ones.

A report matches when task and file are equal and the inclusive line ranges
meet. Pairs are never formed: for a range [s, e] the number of ranges it meets
on the other side is the number that start at or before e, less the number that
end before s. Both are running counts over the lines of one file, taken after
the rows have been summed up per line, so a file with very many rows costs no
more than it has lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom import fixed

_FILE = ["task_id", "file"]
_COUNTERS = ["bug_start", "bug_end", "report_start", "report_end", "bug_rows"]
_ROW = ["side", "task_id", "id", "file", "line_start", "line_end"]


def _points(bugs: DataFrame, reports: DataFrame) -> DataFrame:
    """Two rows per range, one for each end, with what that end adds to the counters of its line.

    A range that ends before it starts adds nothing, and so never matches.
    """

    def of(rows: DataFrame, ident: str, side: str) -> DataFrame:
        bounds = {edge: F.col(f"line_{edge}").cast("bigint") for edge in ("start", "end")}
        sound = F.coalesce(bounds["start"] <= bounds["end"], F.lit(False)).cast("bigint")
        adds = {f"{side}_start": ("start", sound), f"{side}_end": ("end", sound)}
        if side == "bug":
            adds["bug_rows"] = ("start", F.lit(1).cast("bigint"))
        ends = [
            F.struct(
                F.lit(edge).alias("edge"), bounds[edge].alias("line"),
                *[(adds[c][1] if c in adds and adds[c][0] == edge else F.lit(0).cast("bigint")).alias(c) for c in _COUNTERS],
            )
            for edge in ("start", "end")
        ]
        return rows.select(
            F.lit(side).alias("side"), "task_id", F.col(ident).alias("id"), "file",
            bounds["start"].alias("line_start"), bounds["end"].alias("line_end"), F.inline(F.array(*ends)),
        )

    return of(bugs, "bug_id", "bug").unionByName(of(reports, "report_id", "report"))


def line_profile(points: DataFrame) -> DataFrame:
    """Per (task, file, line): ranges of each side started up to it and ended before it, and bugs in the file."""
    per_line = points.groupBy(*_FILE, "line").agg(*[F.sum(c).alias(c) for c in _COUNTERS])
    by_file = Window.partitionBy(*_FILE)
    upto = by_file.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    before = by_file.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    return per_line.select(
        *_FILE, "line",
        F.sum("bug_start").over(upto).alias("bugs_started"),
        F.coalesce(F.sum("bug_end").over(before), zero).alias("bugs_ended"),
        F.sum("report_start").over(upto).alias("reports_started"),
        F.coalesce(F.sum("report_end").over(before), zero).alias("reports_ended"),
        F.sum("bug_rows").over(by_file).alias("bugs_in_file"),
    )


def overlap_match(bugs: DataFrame, reports: DataFrame) -> DataFrame:
    """Every range of both sides with the number of ranges it meets on the other side.

    ``side`` tells bugs from reports; ``bugs_in_file`` counts the bug ranges of
    the same task and file. Equal rows come out once. A range without a line, a
    file or a task meets nothing, but is counted all the same.
    """
    points = _points(bugs, reports).select(*_ROW, "edge", "line", *_COUNTERS)
    profile = line_profile(points)
    started = F.when(F.col("side") == "bug", F.col("reports_started")).otherwise(F.col("bugs_started"))
    ended = F.when(F.col("side") == "bug", F.col("reports_ended")).otherwise(F.col("bugs_ended"))
    placed = F.col("task_id").isNotNull() & F.col("file").isNotNull()
    sound = placed & F.coalesce(F.col("line_start") <= F.col("line_end"), F.lit(False))
    met = F.when(sound, F.col("started") - F.col("ended")).otherwise(F.lit(0).cast("bigint"))
    place = [*_FILE, "line"]
    profile = profile.withColumnsRenamed({c: f"at_{c}" for c in place})
    same = [F.col(c).eqNullSafe(F.col(f"at_{c}")) for c in place]
    return (
        points.select(*_ROW, "edge", "line")
        .join(profile, reduce(Column.__and__, same), "inner")
        .groupBy(*_ROW)
        .agg(
            F.max(F.when(F.col("edge") == "end", started)).alias("started"),
            F.max(F.when(F.col("edge") == "start", ended)).alias("ended"),
            F.max("bugs_in_file").alias("bugs_in_file"),
        )
        .select(*_ROW, met.alias("met"), F.when(placed, F.col("bugs_in_file")).otherwise(0).alias("bugs_in_file"))
    )


def score_counts(bugs: DataFrame, reports: DataFrame) -> DataFrame:
    """Per task: reports, matched reports, reports in a bug file, bugs, matched bugs.

    A report or bug of several ranges matches when any of them does.
    """
    flag = lambda condition: F.max(F.when(condition, 1).otherwise(0))
    per_id = overlap_match(bugs, reports).groupBy("task_id", "side", "id").agg(
        flag(F.col("met") > 0).alias("hit"), flag(F.col("bugs_in_file") > 0).alias("file_hit")
    )
    of = lambda side, value: F.sum(F.when(F.col("side") == side, value).otherwise(0))
    return per_id.groupBy("task_id").agg(
        of("report", 1).alias("reports"),
        of("report", F.col("hit")).alias("matched_reports"),
        of("report", F.col("file_hit")).alias("file_hits"),
        of("bug", 1).alias("bugs"),
        of("bug", F.col("hit")).alias("matched_bugs"),
    )


def with_scores(counts: DataFrame) -> DataFrame:
    """Adds the four measures and their weighted sum; a zero denominator gives null.

    The weights do not add up to one, and the sum is not rescaled. A measure that
    is null makes no contribution; the sum is null when all are.
    """
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    p, r = F.col("line_precision"), F.col("recall")
    names = list(fixed.SCORE_WEIGHTS)
    weighted = sum((F.coalesce(F.col(n), F.lit(0.0)) * w for n, w in fixed.SCORE_WEIGHTS.items()), F.lit(0.0))
    return (
        counts.withColumn("line_precision", ratio("matched_reports", "reports"))
        .withColumn("file_accuracy", ratio("file_hits", "reports"))
        .withColumn("recall", ratio("matched_bugs", "bugs"))
        .withColumn("f1", F.try_divide(p * r * 2.0, p + r))
        .withColumn("weighted_score", F.when(F.coalesce(*names).isNotNull(), weighted))
    )


def score(bugs: DataFrame, reports: DataFrame) -> DataFrame:
    """Scores per task, and one pooled row with a null task, from one aggregation."""
    counts = score_counts(bugs, reports)
    pooled = counts.rollup("task_id").agg(
        F.grouping("task_id").alias("_all"),
        *[F.sum(c).alias(c) for c in ("reports", "matched_reports", "file_hits", "bugs", "matched_bugs")],
    ).withColumn("scope", F.when(F.col("_all") == 1, "pooled").otherwise("task")).drop("_all")
    return with_scores(pooled)
