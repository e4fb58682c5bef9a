"""Pull requests, issues, diffs and candidates on literal rows."""

import pytest
from pyspark.sql import functions as F

from patchloom import schemas
from patchloom.functions import diffs
from patchloom.operators import candidates, issues, patches, pulls
from patchloom.operators.incremental import refresh_latest, resume_anti
from patchloom.plans.collection import candidates_plan, collected_pulls

DIFF = """diff --git a/rtl/core.sv b/rtl/core.sv
index 1..2 100644
--- a/rtl/core.sv
+++ b/rtl/core.sv
@@ -3,5 +3,6 @@ module core;
 keep
--- old comment
+++ b/fake.sv
+assign b = 1;
 more
+tail\r\x85odd
 end
@@ -20 +22,0 @@
-gone
\\ No newline at end of file
diff --git a/dv/tb/top.sv b/dv/tb/top.sv
--- a/dv/tb/top.sv
+++ b/dv/tb/top.sv
@@ -1,2 +1,2 @@
-a
+b

"""
OTHER = """diff --git a/old name.v b/new b/name.v
similarity index 100%
rename from old name.v
rename to new b/name.v
diff --git a/tests/x.py b/tests/x.py
deleted file mode 100644
--- a/tests/x.py
+++ /dev/null
@@ -1 +0,0 @@
-x
diff --git a/n.v b/n.v
new file mode 100644
--- /dev/null
+++ b/n.v\t2024-01-01
@@ -0,0 +1,2 @@
+one
+two
\\ No newline at end of file"""


@pytest.fixture(scope="module")
def diff_table(spark):
    return spark.createDataFrame([("o", "r", 1, DIFF), ("o", "r", 2, OTHER), ("o", "r", 3, "")], schemas.COMPARE_DIFFS)


def test_files_and_counts(diff_table):
    rows = [tuple(r)[2:] for r in patches.file_line_counts(diff_table).orderBy("number", "file_no").collect()]
    assert rows == [
        (1, 1, "rtl/core.sv", 3, 2), (1, 2, "dv/tb/top.sv", 1, 1),
        (2, 1, "name.v", 0, 0), (2, 2, "tests/x.py", 0, 1), (2, 3, "n.v", 2, 0)]


def test_sections_join_back_to_the_diff(diff_table):
    texts = diff_table.select("diff_text", F.array_join(diffs.sections(F.col("diff_text")), "").alias("again")).collect()
    assert all(r.diff_text == r.again for r in texts)


def test_hunks(diff_table):
    rows = [tuple(r)[3:10] for r in patches.diff_hunks(diff_table).filter("number = 1").orderBy("file_no", "hunk_no").collect()]
    assert rows == [
        (1, 1, "HUNK_1", "rtl/core.sv", 3, 5, 3), (1, 2, "HUNK_2", "rtl/core.sv", 20, 1, 22), (2, 1, "HUNK_3", "dv/tb/top.sv", 1, 2, 1)]


def test_lines_and_blocks(diff_table):
    rows = patches.diff_lines(diff_table).filter("number = 1 and file_no = 1").orderBy("hunk_no", "pos").collect()
    assert [(r.kind, r.old_line, r.new_line, r.text) for r in rows] == [
        (" ", 3, 3, "keep"), ("-", 4, None, "-- old comment"), ("+", None, 4, "++ b/fake.sv"), ("+", None, 5, "assign b = 1;"),
        (" ", 5, 6, "more"), ("+", None, 7, "tail\r\x85odd"), (" ", 6, 8, "end"), ("-", 20, None, "gone")]
    blocks = patches.change_blocks(diff_table).orderBy("number", "file_no", "hunk_no", "line_start").collect()
    assert [(r.number, r.hunk_id, r.line_start, r.line_end, r.added, r.removed) for r in blocks] == [
        (1, "HUNK_1", 4, 4, 2, 1), (1, "HUNK_1", 5, 5, 1, 0), (1, "HUNK_2", 20, 20, 0, 1), (1, "HUNK_3", 1, 1, 1, 1),
        (2, "HUNK_1", 1, 1, 0, 1), (2, "HUNK_2", 0, 0, 2, 0)]


def test_blank_line_in_a_hunk_is_context(diff_table):
    last = patches.diff_lines(diff_table).filter("number = 1 and file_no = 2").orderBy(F.desc("pos")).first()
    assert (last.kind, last.old_line, last.new_line, last.text) == (" ", 2, 2, "")


def test_hunk_list(diff_table):
    import json
    found = json.loads(diff_table.filter("number = 2").select(diffs.hunk_list(F.col("diff_text"))).first()[0])
    assert found == [{"HUNK_1": "@@ -1 +0,0 @@\n-x\n"}, {"HUNK_2": "@@ -0,0 +1,2 @@\n+one\n+two\n\\ No newline at end of file"}]


def _pull(number, **over):
    row = {name: None for name in spark_columns()}
    row |= dict(org="o", repo="r", number=number, state="closed", title="Fixes #2", body=None, id=number,
                merge_commit_sha="m", labels=[], draft=False, base=("b" * 40,),
                commits=[("c1", [], "first"), ("c2", ["c1"], "resolves #1")])
    row |= over
    return tuple(row[c] for c in spark_columns())


def spark_columns():
    from pyspark.sql.types import StructType
    return StructType.fromDDL(schemas.PULLS).fieldNames()


def _pulls(spark, *rows):
    import datetime
    when = datetime.datetime(2024, 1, 2, 3, 4, 5)
    return spark.createDataFrame([r if r[spark_columns().index("merged_at")] else r for r in rows], schemas.PULLS).withColumn(
        "merged_at", F.when(F.col("draft"), None).otherwise(F.lit(when)))


def test_candidates(spark, diff_table):
    table = _pulls(
        spark, _pull(1), _pull(2), _pull(3), _pull(4, state="open"), _pull(5, draft=True), _pull(6, title="none", commits=[("c", [], "x")]),
        _pull(7, base=None), _pull(8, commits=[]), _pull(9, commits=None))
    found = spark.createDataFrame([("o", "r", 1, "open", "One", None), ("o", "r", 2, "open", "Two", "b"), ("p", "r", 2, "open", "No", "n")], schemas.ISSUES)
    all_diffs = diff_table.filter("number < 3").unionByName(*[
        spark.createDataFrame([("o", "r", n, DIFF) for n in (4, 5, 6, 7, 8, 9)], schemas.COMPARE_DIFFS)])
    rows = candidates_plan(table, found, all_diffs).collect()
    assert [r.asDict() for r in rows] == [dict(
        repo="o/r", pr_id=1, lang="sv", rtl_files=["rtl/core.sv"], commit_id="b" * 40, timestamp="2024-01-02T03:04:05+00:00",
        pr_title="Fixes #2", pr_body="", merge_commit_sha="m", issue_title="One", issue_body="", commit_message="resolves #1",
        fix_patch=DIFF[:DIFF.index("diff --git a/dv")], test_patch=DIFF[DIFF.index("diff --git a/dv"):],
        modified_files=["rtl/core.sv", "dv/tb/top.sv"], lines_added=4, lines_removed=3)]


def test_the_plan_equals_the_single_steps(spark, diff_table):
    table = _pulls(spark, _pull(1), _pull(2))
    none = spark.createDataFrame([], schemas.ISSUES)
    steps = candidates.single_rtl_candidates(issues.attach_issues(
        patches.has_fix_patch(patches.extract_patches(pulls.link_issues(pulls.merged_only(table)), diff_table)), none))
    assert steps.collect() == candidates_plan(table, none, diff_table).collect()


def test_patches_without_a_base_are_empty(spark, diff_table):
    rows = patches.extract_patches(_pulls(spark, _pull(1, base=None), _pull(2, commits=[]), _pull(3)), diff_table).collect()
    assert {(r.number, r.fix_patch, r.test_patch, tuple(r.modified_files), r.lines_added) for r in rows} == {
        (n, "", "", (), 0) for n in (1, 2, 3)}


def test_two_file_conditions(spark):
    given = [["a.sv"], ["a.sv", "README.md"], ["a.sv", "tb/x.sv"], ["a.sv", "b.v"], ["README.md"], ["a.sv", "a.sv", "test/y"]]
    rows = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, modified_files array<string>")
    both = candidates.single_non_test_file(candidates.single_rtl_file(rows))
    assert [r.i for r in both.orderBy("i").collect()] == [0, 2]
    one = rows.filter(candidates.changes_one_rtl_file(F.col("modified_files")))
    assert [r.i for r in one.orderBy("i").collect()] == [0, 2]


def test_attach_keeps_order_and_rows(spark):
    linked = spark.createDataFrame([("o", "r", 1, [3, 5, 9]), ("o", "r", 2, [7]), ("o", "q", 1, [3])], "org string, repo string, number bigint, issue_numbers array<bigint>")
    found = spark.createDataFrame([("o", "r", n, "open", f"t{n}", None) for n in (9, 3)], schemas.ISSUES)
    rows = {(r.repo, r.number): [i.number for i in r.resolved_issues] for r in issues.attach_issues(linked, found).collect()}
    assert rows == {("r", 1): [3, 9], ("r", 2): [], ("q", 1): []}
    wanted = issues.target_issues(linked)
    assert {tuple(r) for r in issues.pending_issues(wanted, found).collect()} == {("o", "r", 5), ("o", "r", 7), ("o", "q", 3)}


def test_target_issues_pass_over_non_numbers(spark):
    rows = spark.createDataFrame([("o", "r", ["3", "x", "3", None])], "org string, repo string, issue_numbers array<string>")
    assert [tuple(r) for r in issues.target_issues(rows).collect()] == [("o", "r", 3)]


def test_last_record_wins(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, None, "x"), (2, 0, "y")], "id int, at int, v string")
    assert {tuple(r) for r in pulls.dedup_last_wins(rows, ["id"], ["at"]).collect()} == {(1, 3, "c"), (2, 0, "y")}


def test_collected_pulls(spark):
    dump = _pulls(spark, _pull(1), _pull(2, commits=None), _pull(3, commits=None, draft=True)).withColumn("page", F.lit(1))
    again = dump.filter("id = 1").withColumn("title", F.lit("later")).withColumn("page", F.lit(2))
    rows = collected_pulls(dump.unionByName(again), ["page"])
    assert {(r.id, r.title) for r in rows.collect()} == {(1, "later"), (3, "Fixes #2")}
    assert [r.id for r in collected_pulls(dump, ["page"], done=rows.filter("id = 1")).collect()] == [3]


def test_resuming_twice_changes_nothing(spark):
    rows = spark.createDataFrame([("o", "r", i, "open") for i in range(9)], "org string, repo string, number bigint, state string")
    done = rows.filter("number < 4")
    once = done.unionByName(resume_anti(rows, done, pulls.PULL_KEY))
    assert resume_anti(rows, once, pulls.PULL_KEY).count() == 0
    assert once.count() == 9
    newer = rows.withColumn("state", F.lit("closed")).filter("number = 1").withColumn("at", F.lit(2))
    merged = refresh_latest(done.withColumn("at", F.lit(1)), newer, pulls.PULL_KEY, ["at"])
    assert {r.number: r.state for r in merged.collect()} == {0: "open", 1: "closed", 2: "open", 3: "open"}


def test_long_hunks_with_very_many_runs(spark):
    """More runs than are placed at once, against counting line by line."""
    import random

    rng = random.Random(6)
    lines = [rng.choice(["+a", "-b", " c", "", "\\ No newline"]) for _ in range(3000)]
    text = "diff --git a/x.v b/x.v\n--- a/x.v\n+++ b/x.v\n@@ -7,9 +9,9 @@\n" + "".join(x + "\n" for x in lines)
    table = spark.createDataFrame([("o", "r", 1, text), ("o", "r", 2, None)], schemas.COMPARE_DIFFS)
    old, new, want, blocks, block = 7, 9, [], [], None
    for pos, line in enumerate(lines):
        kind = line[:1] if line[:1] in ("+", "-", "\\") else " "
        if kind == " " and block:
            blocks.append(block)
            block = None
        if kind in "+-":
            block = block or [old, 0, 0]
            block[1 if kind == "+" else 2] += 1
        if kind != "\\":
            want.append((pos, kind, old if kind != "+" else None, new if kind != "-" else None, line[1:]))
        old += kind in " -"
        new += kind in " +"
    blocks += [block] if block else []
    rows = patches.diff_lines(table).orderBy("pos").collect()
    assert [(r.pos, r.kind, r.old_line, r.new_line, r.text) for r in rows] == want
    found = patches.change_blocks(table).collect()
    assert [(r.line_start, r.line_end, r.added, r.removed) for r in found] == [
        (at, at + gone - 1, more, gone) if gone else (max(at - 1, 0), max(at - 1, 0), more, 0) for at, more, gone in blocks]


def test_a_later_run_examines_what_is_new(spark, diff_table):
    from patchloom.plans import collection
    from patchloom.session import fresh_path
    from patchloom.sources.sinks import stored_table

    folder = fresh_path(spark, "resumed")
    none = spark.createDataFrame([], schemas.ISSUES)
    text = lambda *numbers: spark.createDataFrame([("o", "r", n, DIFF) for n in numbers], schemas.COMPARE_DIFFS)
    first = _pulls(spark, _pull(1), _pull(2, title="none", commits=[("c", [], "x")]), _pull(3), _pull(4, draft=True))
    run = lambda pulls_, diffs_, name: {(r.pr_id, r.pr_title) for r in collection.resumed_candidates(pulls_, none, diffs_, folder, name).collect()}
    assert run(first, text(1, 2), "1") == {(1, "Fixes #2")}
    ledger = lambda: stored_table(spark, f"{folder}/ledger", "org string, repo string, number bigint, version bigint, run string")
    # rejects are examined; the one whose diff is still to come is not
    assert {r.number for r in ledger().collect()} == {1, 2, 4}
    pending = collection.unexamined(first, ledger(), pulls.PULL_KEY, collection.pull_version())
    assert [r.number for r in pending.collect()] == [3]
    assert [r.number for r in collection.pending_diffs(text(*range(1, 60)), pending).collect()] == [3]
    second = _pulls(spark, _pull(1), _pull(2, title="Fixes #2"), _pull(3), _pull(4, draft=True), _pull(5))
    for _ in range(2):  # a run that is done again ends in the same tables
        assert run(second, text(1, 2, 3, 5), "2") == {(n, "Fixes #2") for n in (1, 2, 3, 5)}
        assert sorted(r.number for r in ledger().filter("run = '2'").collect()) == [2, 3, 5]
    assert run(second, text(1, 2, 3, 5), "3") == {(n, "Fixes #2") for n in (1, 2, 3, 5)}
    assert ledger().filter("run = '3'").count() == 0
    whole = candidates_plan(second, none, text(1, 2, 3, 5))
    assert {(r.pr_id, r.pr_title) for r in whole.collect()} == {(n, "Fixes #2") for n in (1, 2, 3, 5)}


def test_candidates_take_the_last_row_of_an_issue(spark, diff_table):
    found = spark.createDataFrame([("o", "r", 1, "open", t, None, k) for k, t in enumerate(["old", "new"])], schemas.ISSUES + ", landed int")
    rows = candidates_plan(_pulls(spark, _pull(1)), found, diff_table, issue_order=["landed"]).collect()
    assert [r.issue_title for r in rows] == ["new"]


def test_an_issue_that_landed_twice_counts_once(spark):
    linked = spark.createDataFrame([("o", "r", 1, [3])], "org string, repo string, number bigint, issue_numbers array<bigint>")
    found = spark.createDataFrame([("o", "r", 3, "open", t, None, k) for k, t in enumerate(["old", "new"])], schemas.ISSUES + ", landed int")
    row = issues.attach_issues(linked, found, ["landed"]).first()
    assert [i.title for i in row.resolved_issues] == ["new"]
