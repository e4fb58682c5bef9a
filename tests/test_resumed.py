from pyspark.sql import functions as F

from patchloom.catalog import QUERIES
from patchloom.catalog.registry import Tables
from patchloom.operators.incremental import unexamined
from patchloom.operators.pulls import PULL_JOIN
from patchloom.sources.sinks import stored_table

_ROWS, _LEDGER = "org string, repo string, number bigint, v bigint, text string", "org string, repo string, number bigint, version bigint, run string"


def test_unexamined_rows(spark):
    rows = [("o", "r", 1, 5, "a"), ("o", "r", 1, 5, "b"), ("o", "r", 1, 6, "c"), ("o", "r", 2, None, "d"), ("o", None, 3, 5, "e"), ("p", "r", 1, 5, "f"), ("o", "r", 4, 7, "g")]
    ledger = [("o", "r", 1, 5, "x"), ("o", "r", 1, 5, "y"), ("o", "r", 2, None, "x"), ("o", None, 3, 5, "x"), ("o", "r", 4, 8, "x"), ("o", "r", 4, 7, "y")]
    found = unexamined(spark.createDataFrame(rows, _ROWS), spark.createDataFrame(ledger, _LEDGER), PULL_JOIN, F.col("v"))
    assert sorted(found.columns) == ["number", "org", "repo", "text", "v"]
    assert sorted(r["text"] for r in found.collect()) == ["c", "d", "e", "f"]


def test_unexamined_rows_move_once(spark):
    """What a ledger leaves is joined with diffs on the same key and stays where it is."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, ledger = spark.createDataFrame([("o", "r", 1, 5, "a")], _ROWS), spark.createDataFrame([("o", "r", 1, 6, "x")], _LEDGER)
        joined = unexamined(rows, ledger, PULL_JOIN, F.col("v")).join(rows.select(*PULL_JOIN, F.col("text").alias("diff")), PULL_JOIN)
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_an_absent_table_needs_no_worker(spark, tmp_path):
    none = stored_table(spark, str(tmp_path / "none"), _LEDGER)
    assert none.columns == ["org", "repo", "number", "version", "run"] and none.count() == 0
    assert none.dtypes == spark.createDataFrame([], _LEDGER).dtypes
    assert "ExistingRDD" not in none._jdf.queryExecution().executedPlan().toString()


def test_resumed_runs_share_what_has_landed(spark, sf_dir, monkeypatch):
    made, real = [], Tables.diffs
    monkeypatch.setattr(Tables, "diffs", lambda t: made.append(t) or real(t))
    assert QUERIES["resumed_candidates"](spark, sf_dir).count()
    assert len(made) == 1
