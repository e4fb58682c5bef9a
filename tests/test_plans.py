"""Plan shapes: what must not be in a plan that has to run on very large tables."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from patchloom import schemas
from patchloom.catalog import QUERIES
from patchloom.operators import annotation, issues, materials, patches, pulls, scoring
from patchloom.operators.sketch import key_sketch
from patchloom.operators.summaries import StageCounts
from patchloom.session import materialised


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no table is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _without_sketches(plan):
    """A plan without the subqueries that build key sketches: these end in one row of fixed size."""
    out, depth = [], None
    for line in plan.split("\n"):
        at = line.find("Subquery subquery#")
        mark = re.search(r"[A-Za-z(*]", line)
        here = mark.start() if mark else 0
        if depth is not None and here > depth:
            continue
        depth = at if at >= 0 else None
        if depth is None:
            out.append(line)
    return "\n".join(out)


# Queries that write and read back are covered by the tables they are made of.
_LAZY = sorted(set(QUERIES) - {
    "construct", "stream_dedup", "failures_sink", "final_structs", "route_by_review", "resume_append", "write_stage", "stage_funnel", "annotation_join",
    "resumed_candidates", "repo_files_scan"})


@pytest.mark.parametrize("name", _LAZY)
def test_no_pair_join_no_python_no_single_partition(spark, sf_dir, no_broadcast, name):
    plan = _without_sketches(_plan(QUERIES[name](spark, sf_dir)))
    for node in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "BroadcastHashJoin"):
        assert node not in plan
    assert ("MapInPandas" in plan) == (name == "answer_requests")
    if name != "bad_line_count":  # a report of one row
        assert "SinglePartition" not in plan


@pytest.fixture(scope="module")
def landed(spark):
    """Landed tables as parquet, so that scans show what is read of them."""
    table = lambda ddl, name: materialised(spark.createDataFrame([], ddl), name)
    return {n: table(getattr(schemas, n), n.lower()) for n in (
        "PULLS", "ISSUES", "COMPARE_DIFFS", "REPO_FILES", "REPO_CONFIG", "CANDIDATES")}


def _formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    # what follows is the subqueries that build key sketches
    return df._jdf.queryExecution().explainString(mode).split("===== Subqueries =====")[0]


def test_filters_and_columns_reach_the_scan(spark, landed):
    plan = _formatted(pulls.link_issues(pulls.merged_only(landed["PULLS"])).select("org", "repo", "number", "issue_numbers"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(state,closed\).*\]", plan) and "IsNotNull(merged_at)" in plan
    assert "html_url" not in plan and "message:string" in plan and "parents" not in plan


def test_diff_tables_do_not_shuffle(spark, landed):
    diffs = landed["COMPARE_DIFFS"]
    for df in (patches.diff_files(diffs), patches.file_line_counts(diffs), patches.diff_hunks(diffs), patches.parse_diffs(diffs),
               patches.diff_lines(diffs), patches.change_blocks(diffs), patches.hunk_counts(diffs)):
        plan = _plan(df)
        assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_diffs_stay_where_they_are_for_annotations(spark, landed, no_broadcast):
    answers = materialised(spark.createDataFrame([], "org string, repo string, number bigint, content string"), "answers")
    for df in (annotation.annotation_notes(answers, landed["COMPARE_DIFFS"]), annotation.hunk_shortlists(answers, landed["COMPARE_DIFFS"])):
        moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", _formatted(df))
        assert moved and not any(name in m for m in moved for name in ("diff_text#", "hunk#", "_lines#", "_runs#", "_told#"))


def test_selected_texts_move_once(spark, landed, no_broadcast):
    selected = materialised(spark.createDataFrame([], schemas.SELECTED_DOCS), "selected")
    ready = materialised(spark.createDataFrame([], schemas.MATERIALS), "ready")
    plan = _formatted(materials.official_specs(selected, ready, landed["REPO_FILES"]))
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    # the gathering of partial lists is the one exchange that holds texts
    assert sum("buf#" in m or "content#" in m or "texts#" in m for m in moved) == 1, moved


def test_a_stored_stage_is_read_once(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") % 4 == 0, "no").alias("error"))
    counts = StageCounts()
    stored = materialised(counts.seen("s", rows, loaded=F.lit(True), written=F.col("error").isNull(), failed=F.col("error").isNotNull()), "s")
    lines = counts.seen("lines", spark.range(7), loaded=F.col("id") > 1, bad=F.col("id") <= 1)
    materialised(lines.filter("id > 5"), "lines")
    table = counts.table(spark)
    assert {tuple(r) for r in table.collect()} == {("s", 100, 0, 75, 25), ("lines", 5, 2, 0, 0)} and stored.count() == 100
    empty = StageCounts()
    materialised(empty.seen("none", rows.limit(0), loaded=F.lit(True), failed=F.col("error").isNotNull()), "none")
    assert [tuple(r) for r in empty.table(spark).collect()] == [("none", 0, 0, 0, 0)]


def test_issue_join_moves_no_pull_text(spark, landed, no_broadcast):
    linked = landed["PULLS"].withColumn("issue_numbers", F.array(F.lit(1).cast("bigint")))
    plan = _formatted(issues.resolve_issues(linked, landed["ISSUES"]))
    read = [x for x in re.findall(r"ReadSchema: (.*)", plan)]
    assert any(x.count(":") == 3 for x in read), read


def test_file_contents_are_cut_down_before_they_move(spark, landed):
    """With many files of which few are wanted, about the wanted ones leave the scan, and no title is made for other commits."""
    sha = lambda i: F.md5(i.cast("string"))
    files = spark.range(40_000).select(
        F.lit("o/r").alias("repo"), sha(F.floor(F.col("id") / 4)).alias("commit_sha"),
        F.when(F.col("id") % 4 < 2, F.concat(F.lit("rtl/a"), (F.col("id") % 4).cast("string"), F.lit(".sv"))).otherwise(
            F.concat(F.lit("doc/d"), (F.col("id") % 4).cast("string"), F.lit(".md"))).alias("path"),
        F.concat(F.lit("# T"), F.col("id").cast("string")).alias("content"))
    wanted = spark.range(50).select(F.lit("o/r").alias("repo"), sha(F.col("id") * 100).alias("commit_sha"), F.lit("rtl/a0.sv").alias("path"))
    keys = ["repo", "commit_sha", "path"]
    passed = files.filter(key_sketch(wanted, keys)(*map(F.col, keys)))
    assert passed.join(wanted, keys, "left_semi").count() == 50 and passed.count() <= 55
    config = spark.createDataFrame([("o/r", "u", ["doc"], "rtl", [".sv"])], schemas.REPO_CONFIG)
    entries = materials.doc_entries(files, config, wanted.select("repo", "commit_sha"))
    assert 100 <= entries.count() <= 110
    ready, _ = materials.materials_join(landed["CANDIDATES"], landed["REPO_CONFIG"], landed["REPO_FILES"])
    assert "LeftSemi" not in _plan(ready)


def test_sketches_hold_all_their_keys(spark):
    keys = spark.range(30_000).select((F.col("id") * 3).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("b"))
    rows = keys.unionAll(spark.range(30_000).select(F.col("id") * 3 + 1, F.lit("x")))
    for words in (1 << 14, 16):
        held = key_sketch(keys, ["a", "b"], words)
        found = rows.filter(held(F.col("a"), F.col("b"))).agg(F.count_if(F.col("a") % 3 == 0), F.count("*")).first()
        assert found[0] == 30_000 and (found[1] < 40_000 or words == 16)
    assert rows.filter(key_sketch(keys.limit(0), ["a", "b"])(F.col("a"), F.col("b"))).count() == 0
    mixed = key_sketch(keys.select(F.col("a").cast("int").alias("a"), "b"), ["a", "b"])
    assert keys.filter(mixed(F.col("a"), F.col("b"))).count() == 30_000  # types may differ, texts count


def test_a_document_is_parsed_once_for_all_its_commits(spark):
    """A hundred commits with one unchanged document: its text is read for a title at one commit only."""
    files = spark.range(300).select(
        F.lit("o/r").alias("repo"), F.format_string("%03d", F.floor(F.col("id") / 3)).alias("commit_sha"),
        F.element_at(F.array(F.lit("doc/a.md"), F.lit("doc/b.md"), F.lit("doc/c.md")), (F.col("id") % 3 + 1).cast("int")).alias("path"),
        F.when(F.col("id") % 3 == 0, "# Same").when(F.col("id") % 3 == 1, F.concat(F.lit("# Changes "), (F.col("id") % 4).cast("string"))).alias("content"))
    named = files.withColumn("blob_sha", F.md5("content"))
    config = spark.createDataFrame([("o/r", "u", ["doc"], "rtl", [".sv"])], schemas.REPO_CONFIG)
    plain = sorted(map(tuple, materials.doc_entries(files, config).collect()))
    assert sorted(map(tuple, materials.doc_entries(named, config).collect())) == plain and len(plain) == 200
    # where the text is missing at all commits but the least, titles are still found: no other text is looked at
    once = named.withColumn("least", F.min("commit_sha").over(Window.partitionBy("path", "blob_sha")))
    once = once.withColumn("content", F.when(F.col("commit_sha") == F.col("least"), F.col("content"))).drop("least")
    assert sorted(map(tuple, materials.doc_entries(materialised(once, "once"), config).collect())) == plain


def test_documents_move_without_their_text(spark, landed, no_broadcast):
    ready, _ = materials.materials_join(landed["CANDIDATES"], landed["REPO_CONFIG"], landed["REPO_FILES"])
    plan = _formatted(ready.select("repo", "pr_id", "doc_toc"))
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    # the one exchange with a text is that of the source files
    assert len(moved) >= 5 and sum("content#" in x or "fixed_rtl_code#" in x for x in moved) == 1, moved


def test_scores_read_each_table_twice_at_most(spark, no_broadcast):
    ddl = "task_id bigint, {} bigint, file string, line_start bigint, line_end bigint"
    bugs, reports = (materialised(spark.createDataFrame([], ddl.format(n)), n) for n in ("bug_id", "report_id"))
    plan = _plan(scoring.score(bugs, reports))
    assert plan.count("FileScan") == 4
    assert plan.count("SortMergeJoin") == 1


def test_copies_of_a_key_are_cut_down_before_the_shuffle(spark, landed):
    plan = _plan(pulls.dedup_last_wins(landed["PULLS"], ["id"], ["updated_at"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_lines_are_cut_in_batches(spark, landed):
    """Array functions over every line cost some 18 microseconds a line."""
    plan = _plan(patches.diff_lines(landed["COMPARE_DIFFS"]))
    assert "MapInArrow" in plan and "Generate" not in plan and "Exchange" not in plan


def test_lines_are_dealt_out_once_by_pull_request(spark, sf_dir, no_broadcast):
    """Commits and diffs meet the pull requests where the narrow lines already are."""
    for name, dealt in (("drop_unfetched_merged", 2), ("fix_test_split", 3)):
        assert len(re.findall(r"Exchange hashpartitioning", _plan(QUERIES[name](spark, sf_dir)))) == dealt
