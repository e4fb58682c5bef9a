"""Diffs are parsed after the join: what is sorted for it is narrow, and odd texts are told as before."""

import re

import pytest

from patchloom.catalog import QUERIES, Tables
from patchloom.fixed import TEST_PATH_KEYWORDS
from patchloom.operators import patches
from tests.test_plans import _formatted

PATH = re.compile(r'^(?:--- "?a/(?=[^\n]*\n\+\+\+ /dev/null)|\+\+\+ "?b/)([^\t\n"]+)', re.M)
NAMED = re.compile(r'\Adiff --git [^\n]* "?b/([^\n"]+)')

TEXTS = [
    None, "", "junk\n+x", "diff --git ", "diff --git \ndiff --git ", "diff --git +++ b/x.v b/y.v\n+a\n@@ -1 +1 @@\n+b\n-c\n",
    "diff --git a/q.v b/q.v\n--- a/q.v\n+++ b/q.v\n@@ -1 +1 @@\n-é\n+ü\n+++ z\n\ndiff --git a/tb/t b/tb/t\nold mode 1",
    "x\ndiff --git a/tests/r b/tests/r\n--- a/tests/r\n+++ /dev/null\n@@ -1 +0,0 @@\n-a\ndiff --git a/ü b/ü\n+++ b/ü\n+k\n@@ -1 +1 @@ @@ -2\n+1\n+\n",
    "diff --git a/a b/a\ndiff --git a/tb b/tb\ndiff --git a/a b/a\n\n@@ -x\n+y\n\ndiff --git\n+w",
]


def plain(text):
    if text is None:
        return None, None, None, None, None
    sections = [s for s in re.split(r"(?m)^(?=diff --git )", text) if s.startswith("diff --git ")]
    heads = [s.split("\n@@ -", 1)[0] for s in sections]
    paths = [(PATH.search(h) or NAMED.search(h) or [None, ""])[1] for h in heads]
    test = [any(k in p.lower() for k in TEST_PATH_KEYWORDS) for p in paths]
    count = lambda sign: sum(s.count("\n" + sign) - h.count("\n" + sign) for s, h in zip(sections, heads))
    return ("".join(s for s, t in zip(sections, test) if not t), "".join(s for s, t in zip(sections, test) if t),
            list(dict.fromkeys(paths)), count("+"), count("-"))


def test_odd_diffs(spark):
    rows = spark.createDataFrame([("o", "r", i, t) for i, t in enumerate(TEXTS)], "org string, repo string, number bigint, diff_text string")
    found = {r.number: (r.fix_patch, r.test_patch, r.modified_files, r.lines_added, r.lines_removed) for r in patches.parse_diffs(rows).collect()}
    assert found == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_repeated_and_missing_keys(spark):
    table = "org string, repo string, number bigint, base struct<sha:string>, commits array<struct<sha:string>>"
    pulls = spark.createDataFrame([("o", "r", 5, ("b",), [("c",)]), ("o", "r", 5, ("b",), [("c",)]), ("o", "r", 5, (None,), [("c",)]), (None, "r", 5, ("b",), [("c",)])], table)
    diffs = spark.createDataFrame([("o", "r", 5, TEXTS[6]), ("o", "r", 5, None), (None, "r", 5, TEXTS[6])], "org string, repo string, number bigint, diff_text string")
    rows = patches.extract_patches(pulls, diffs).select("org", "fix_patch", "modified_files", "lines_added").collect()
    whole = plain(TEXTS[6])
    assert sorted(map(repr, [tuple(r) for r in rows])) == sorted(map(repr, [
        ("o", whole[0], whole[2], whole[3]), ("o", "", [], 0), ("o", whole[0], whole[2], whole[3]), ("o", "", [], 0),
        ("o", "", [], 0), ("o", "", [], 0), (None, "", [], 0)]))


@pytest.mark.parametrize("name", ["fix_test_split", "has_fix_patch"])
def test_no_text_is_sorted(spark, sf_dir, name):
    """Sorted rows hold neither patches nor commits: both are made of narrow rows that meet first."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _formatted(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sorts = re.findall(r"\(\d+\) Sort\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert len(sorts) == 4 and not any(re.search("patch|text|_files|commits", s) for s in sorts), sorts


def test_texts_of_parts_are_the_texts_of_diffs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    keys = ["org", "repo", "number"]
    from patchloom.catalog.views import diff_of_parts
    made = t.diff_parts().select(*keys, diff_of_parts().alias("diff_text"))
    assert made.exceptAll(t.diffs()).count() == 0 and t.diffs().exceptAll(made).count() == 0
