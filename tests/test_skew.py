"""A third of all rows under one key: results stay whole."""

from pyspark.sql import functions as F

from patchloom.operators import issues, pulls, scoring
from patchloom.operators.summaries import run_summary

ROWS = 90_000


def _hot(key="id"):
    """The key of every row; a third of them share key 0."""
    return F.when(F.col(key) % 3 == 0, 0).otherwise(F.col(key)).cast("bigint")


def test_copies_of_one_key(spark):
    rows = spark.range(ROWS).select(_hot().alias("key"), F.col("id").alias("at"))
    kept = pulls.dedup_last_wins(rows, ["key"], ["at"])
    assert kept.count() == ROWS - ROWS // 3 + 1
    assert kept.filter("key = 0").first().at == ROWS - 3


def test_one_issue_named_by_a_third_of_all_pulls(spark):
    linked = spark.range(ROWS).select(
        F.lit("o").alias("org"), F.lit("r").alias("repo"), F.col("id").alias("number"),
        F.array(_hot(), F.col("id") + ROWS).alias("issue_numbers"))
    found = spark.range(ROWS).select(
        F.lit("o").alias("org"), F.lit("r").alias("repo"), F.col("id").alias("number"), F.lit("open").alias("state"),
        F.lit("t").alias("title"), F.lit(None).cast("string").alias("body"))
    rows = issues.attach_issues(linked, found)
    assert rows.count() == ROWS
    assert rows.filter("size(resolved_issues) = 1 and resolved_issues[0].number = 0").count() == ROWS // 3


def test_one_file_with_a_third_of_all_ranges(spark):
    def ranges(ident, shift):
        return spark.range(ROWS).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("task_id"), F.col("id").alias(ident),
            F.lit("f").alias("file"), (F.col("id") % 1000 + shift).alias("line_start"), (F.col("id") % 1000 + shift).alias("line_end"))

    met = scoring.overlap_match(ranges("bug_id", 0), ranges("report_id", 500))
    assert met.count() == 2 * ROWS
    # One-line ranges meet where the lines are equal, so pairs count the same from either side.
    sides = {r.side: r.pairs for r in met.groupBy("side").agg(F.sum("met").alias("pairs")).collect()}
    per_line = lambda rows: rows.groupBy("task_id", "line_start").count()
    pairs = per_line(ranges("bug_id", 0)).join(per_line(ranges("report_id", 500)).withColumnRenamed("count", "other"), ["task_id", "line_start"])
    wanted = pairs.agg(F.sum(F.col("count") * F.col("other"))).first()[0]
    assert sides == {"bug": wanted, "report": wanted} and wanted > ROWS


def test_one_repository_with_a_third_of_all_results(spark):
    rows = spark.range(ROWS).select(
        F.lit("o").alias("org"), (_hot() % 1000).cast("string").alias("repo"), F.when(F.col("id") == 5, 2).otherwise(0).alias("return_code"))
    total = run_summary(rows).filter("org is null").first()
    assert (total.success, total.failures) == (total.total - 1, 1)
