"""Text, path, reference and title rules on literal values."""

import pytest
from helpers import values
from pyspark.sql import functions as F

from patchloom import fixed
from patchloom.functions import paths, refs, titles
from patchloom.functions.text import BLANKS, iso_utc, lines, strip


def test_blanks_are_exactly_the_ones_that_strip_drops():
    assert sorted(BLANKS) == sorted(c for c in map(chr, range(0x3100)) if not c.strip())


def test_strip_and_lines(spark):
    assert values(spark, [BLANKS + "a b" + BLANKS, BLANKS, ""], strip) == ["a b", "", ""]
    text = "a\r\nb\rc\x0bd\x85e f\n"
    assert values(spark, [text], lines) == [text.splitlines() + [""]]


@pytest.mark.parametrize("path,expected", [
    ("rtl/core.sv", False), ("rtl/outbound_fifo.sv", True), ("rtl/latest.sv", True), ("DV/TB/top.sv", True),
    ("a/E2E/x.v", True), ("src/alu.v", False),
])
def test_test_paths_are_found_by_substring(spark, path, expected):
    assert values(spark, [path], paths.is_test_path) == [expected]
    assert any(k in path.lower() for k in fixed.TEST_PATH_KEYWORDS) == expected


def test_test_paths_by_segment(spark):
    found = values(spark, ["rtl/outbound.sv", "dv/tb/top.sv", "rtl/test.sv", "latest/x.v", "testing/a"],
                   lambda p: paths.is_test_path(p, whole_segments=True))
    assert found == [False, True, True, False, True]


def test_rtl_lang(spark):
    given = ["a/b.v", "a/b.SV", "b.svh", "dir.v/Makefile", ".v", "x/.sv", "a.v.bak", "a..v", "noext", "a.vh"]
    assert values(spark, given, paths.rtl_lang) == ["v", "sv", "sv", None, None, None, None, "v", None, None]


def test_doc_files(spark):
    rows = spark.createDataFrame(
        [("doc/a.md", ["doc/"]), ("docs/a.md", ["doc"]), ("doc/b.RST", ["x", "doc"]), ("doc/c.txt", ["doc"]), ("z.md", []),
         ("z.md", None)], "path string, dirs array<string>")
    found = [r[0] for r in rows.select(paths.is_doc_file(F.col("path"), F.col("dirs"))).collect()]
    assert found == [True, False, True, False, True, True]


def test_keyword_references(spark):
    given = [
        "Fixes #12 and closes\n#00013", "fixes: #9 org/r#5 fix#3", "prefix #1 unresolved #2", "close #0",
        "see #12close #3", "RESOLVED \t #4, fix  #5x", "修复 #12", "修复fix #12", "fix #99999999999999999999",
        "_fix #3", "fix #6",
    ]
    assert values(spark, given, refs.keyword_issue_refs) == [
        [12, 13], [], [], [], [3], [4, 5], [], [], [], [], [6]]


def test_references_agree_with_a_plain_scan(spark):
    import re
    pieces = ["fix", "Fixes", "closed", "x", "_", " ", "\n", "#", "12", "0", "7", "é", ":"]
    import random
    rng = random.Random(5)
    texts = ["".join(rng.choice(pieces) for _ in range(40)) for _ in range(400)]
    wanted = [[int(n) for w, n in re.findall(r"(\w+)\s+#([0-9]+)", t) if w.lower() in fixed.CLOSING_KEYWORDS and int(n) > 0 and int(n) < 2**63]
              for t in texts]
    assert values(spark, texts, refs.keyword_issue_refs) == wanted


def test_a_very_long_word_is_scanned_in_linear_time(spark):
    text = "a" * 2_000_000 + " fix #5"
    assert values(spark, [text], refs.keyword_issue_refs) == [[5]]


def test_url_references(spark):
    text = "https://github.com/a/b/issues/7 http://GitHub.com/a/b/issues/8 github.com/o/r/issues/9x github.com/a/b/pull/3 github.com/a/b/issues/0"
    assert values(spark, [text], refs.url_issue_refs) == [[7, 9]]
    own = values(spark, [text], lambda t: refs.url_issue_refs(t, F.lit("o"), F.lit("r")))
    assert own == [[9]]


def test_union_is_distinct_and_ascending(spark):
    assert values(spark, ["fix #9 fix #2 github.com/a/b/issues/9"], refs.ref_union) == [[2, 9]]


def test_comments(spark):
    given = ["a<!-- x\ny -->b<!-- z -->c", "a<!-- open", "<!---->x"]
    assert values(spark, given, refs.strip_html_comments) == ["abc", "a<!-- open", "x"]


def test_pr_text(spark):
    rows = spark.createDataFrame([("t", None, ["m1", "m2"]), (None, "b", []), ("t", "b", None)], "t string, b string, m array<string>")
    assert [r[0] for r in rows.select(refs.pr_text(F.col("t"), F.col("b"), F.col("m"))).collect()] == ["t\n\nm1\nm2", "\nb\n", "t\nb\n"]


def test_titles(spark):
    given = [
        ("a.md", "intro\n  # First  \n# Second"), ("a.rst", "x\n.. title:: Physical Memory Protection\n"),
        ("docs/pmp_unit.sv", "# no"), ("a.MD", "#none\n##two\n```\n# in fence\n```"), ("a.rst", "Head\n====\nx"),
        ("a.rst", "Longer head\n===\n\nNext\n~~~~~"), ("b.rst", "Head\n*****"), ("dir/2nd_IO-map.rst", ""), ("dir/---.md", "x"),
        ("a.rst", "A\n=-\nB\r\n^^"), ("t.rst", "Over\n----\n.. TITLE::Late"),
    ]
    rows = spark.createDataFrame([(i, *g) for i, g in enumerate(given)], "i int, p string, c string")
    found = [r[0] for r in rows.orderBy("i").select(titles.doc_title(F.col("p"), F.col("c"))).collect()]
    assert found == ["First", "Physical Memory Protection", "Pmp Unit", "in fence", "Head", "Next", "B", "2Nd Io Map", "---", "B", "Late"]


def test_name_title_equals_title_case(spark):
    names = ["pmp_unit.sv", "2nd.v", "a1b2c.md", "ALL_CAPS.rst", "x"]
    stems = ["pmp unit", "2nd", "a1b2c", "ALL CAPS", "x"]
    assert values(spark, names, titles.name_title) == [s.title() for s in stems]


def test_toc(spark):
    rows = spark.createDataFrame(
        [([("doc/a.md", "A"), ("doc/b.rst", "B")],), ([],), (None,)], "toc array<struct<path:string,title:string>>")
    found = [r[0] for r in rows.select(titles.format_doc_toc(F.col("toc"))).collect()]
    assert found == ["- doc/a.md: A\n- doc/b.rst: B", fixed.EMPTY_TOC, fixed.EMPTY_TOC]


def test_iso_text_is_utc_in_any_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        moment = F.timestamp_seconds(F.lit(1700000000))
        assert spark.range(1).select(iso_utc(moment)).first()[0] == "2023-11-14T22:13:20+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
