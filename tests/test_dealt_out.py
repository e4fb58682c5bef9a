"""The step that the construction queries share: narrow rows, gathered once, and keys that tell rows apart first."""

import re

import pytest
from pyspark.sql import functions as F

from patchloom.catalog import Tables
from patchloom.functions import diffs
from patchloom.functions.paths import rtl_lang
from patchloom.operators.candidates import changes_one_rtl_file
from tests.helpers import values


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """A folder with a line table of its own: a pull request with a repeated line and a null in a line, one of one file, one without key."""
    folder = tmp_path_factory.mktemp("lines")
    rows = [(5, 3, 7, 1, 2.0), (5, 8, 7, 2, 3.0), (5, 8, 7, 2, 3.0), (5, 11, None, 3, 9.0), (6, 8, 1, 1, None), (None, 1, 1, 1, 1.0)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double").write.parquet(
        f"{folder}/lineitem.parquet")
    return str(folder)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_commits_are_those_of_the_view(spark, lines):
    t = Tables(spark, lines)
    found = {r.number: [(c.sha, c.parents[0], c.message) for c in r.commits] for r in t.commits().collect()}
    view = {}
    for r in t.view("pull_commits").orderBy("pos").collect():
        view.setdefault(r.number, []).append((r.sha, r.parent_sha, r.message))
    assert found == view
    assert [m for _, _, m in found[5]] == [None, "resolves #5" if len("1-3-7") % 3 == 0 else "step 1-3-7", "step 2-8-7"]


def test_texts_of_diffs_are_made_after_gathering(spark, lines):
    rows = Tables(spark, lines).view("pull_diffs")
    found = {r.number: r.diff_text for r in rows.collect()}
    assert found[5].count("diff --git ") == 2 and found[5].index("core_8.sv") > found[5].index("doc/readme.md")
    assert found[6] is None and found[None] is None  # nothing of them can be told
    assert "listagg" not in plan(rows) and "Window" not in plan(rows)


def test_keys_are_sorted_by_number_first(spark, sf_dir):
    """Names of repositories are equal most of the time: sorts that begin with them compare whole rows."""
    t = Tables(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [plan(t.pulls()), plan(t.candidates())]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in plans:
        sorts = re.findall(r"Sort \[(\w+)#\w+ ASC", text)
        assert sorts and not {"org", "repo"} & set(sorts)


def test_sections_are_cut_at_lines_only(spark):
    texts = ["diff --git a b\nx\ndiff --git c d\n", "junk\ndiff --git a b", " diff --git a\n+diff --git b", "", None,
             "diff --git ", "\n\ndiff --git a\r\ndiff --git b\n\n", "diff --git a diff --git b\n+x\ndiff --git "]
    found = values(spark, texts, diffs.sections)
    assert found == [None if t is None else [s for s in re.split(r"(?m)^(?=diff --git )", t) if s.startswith("diff --git ")] for t in texts]


def test_one_source_file(spark):
    rows = [["a.v"], ["a.SV", "tests/x.py"], ["a.v", "b.sv"], ["a.v", "doc.md"], ["doc.md"], ["tb/a.v"], [], None, ["a.v", None]]
    assert values(spark, rows, changes_one_rtl_file, kind="array<string>")[:7] == [True, True, False, False, False, False, False]
    assert values(spark, rows, lambda c: F.coalesce(changes_one_rtl_file(c), F.lit(False)), kind="array<string>")[7:] == [False, True]
    assert values(spark, ["a.v", "a.Svh", "a.sv/b", ".v", None], rtl_lang) == ["v", "sv", None, None, None]
