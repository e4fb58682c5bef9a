"""Readers, writers, repository lists and arrivals."""

import os

import pytest
from pyspark.sql import functions as F

from patchloom import fixed, schemas
from patchloom.session import fresh_path, materialised, run_scope, shared_folder
from patchloom.sources import dumps, files, jsonl, repos, sinks
from patchloom.streaming.arrivals import stream_dedup, take_new, taken_records

SCHEMA = "id bigint, name string, tags array<string>"


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


LINES = '{"id": 1, "name": "a", "tags": []}\n\n  \n{"id": 2, "name"\n{"id": "x", "name": "c"}\n[1]\n7\nnull\n{"id": 3, "other": 1}\r\n{"id": 4, "name": "d e"}'


def test_tolerant(spark, tmp_path):
    _write(tmp_path / "d", "o__r_s01_01_prs.jsonl", LINES)
    lines = jsonl.text_lines(spark, str(tmp_path / "d"))
    rows = [tuple(r) for r in jsonl.read_jsonl_tolerant(lines, SCHEMA).collect()]
    assert rows == [(1, "a", []), (None, "c", None), (3, None, None), (4, "d e", None)]
    assert [tuple(r) for r in jsonl.bad_line_count(lines, SCHEMA).collect()] == [("o__r_s01_01_prs.jsonl", 8, 4, 1)]
    assert [r.value for r in jsonl.bad_lines(lines, SCHEMA).collect()] == ['{"id": 2, "name"', "[1]", "7", "null"]


def test_missing_path_reads_as_empty(spark, tmp_path):
    lines = jsonl.text_lines(spark, str(tmp_path / "none"))
    assert jsonl.read_jsonl_tolerant(lines, SCHEMA).count() == 0


@pytest.mark.parametrize("bad", ["", "  ", "{oops", "[1]"])
def test_strict_fails_on_one_bad_line(spark, bad):
    good = '{"id": 1, "name": "a"}'
    table = lambda *lines: spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.id for r in jsonl.read_jsonl_strict(table(good, '{"id": "x"}'), SCHEMA).collect()] == [1, None]
    with pytest.raises(Exception, match="broken line"):
        jsonl.read_jsonl_strict(table(good, bad), SCHEMA).collect()


def test_dump_keeps_unknown_and_empty_commits_apart(spark):
    given = [
        '{"number": 1, "id": 11, "state": "closed", "merged_at": "2024-01-02T03:04:05Z", "commits": [{"sha": "s", "parents": [{"sha": "p"}], "commit": {"message": "m"}}], "labels": [{"name": "l"}], "base": {"sha": "b", "ref": "main"}}',
        '{"number": 2, "id": 12, "state": "closed", "merged_at": "2024-01-02T03:04:05Z"}',
        '{"number": 3, "id": 13, "state": "open", "merged_at": null}',
        '{"number": 4, "id": 14, "state": "closed", "merged_at": "2024-01-02T03:04:05Z", "commits": []}']
    rows = dumps.pulls_from_dump(spark.createDataFrame([("o", "r", g) for g in given], "org string, repo string, payload string"))
    from pyspark.sql.types import StructType
    assert rows.columns == StructType.fromDDL(schemas.PULLS).fieldNames() and len(rows.columns) == 26
    found = {r.number: r for r in rows.collect()}
    assert [tuple(c) for c in found[1].commits] == [("s", ["p"], "m")] and found[1].labels == ["l"] and found[1].base.sha == "b"
    assert (found[2].commits, found[3].commits, found[4].commits) == (None, [], [])


def test_write_and_resume(spark):
    path = fresh_path(spark, "t")
    rows = spark.createDataFrame([("o", r, i) for r, i in (("a", 1), ("b", 2), ("a", 3))], "org string, repo string, number bigint")
    sinks.write_stage(rows, path, sort_desc="number")
    sinks.write_stage(rows.filter("number = 2"), path, resume=True)
    read = spark.read.schema(rows.schema).parquet(path)
    assert sorted(r.number for r in read.collect()) == [1, 2, 2, 3]
    sinks.write_stage(rows.filter("number = 2"), path)
    assert [r.number for r in spark.read.schema(rows.schema).parquet(path).collect()] == [2]


def test_a_stage_done_again_leaves_its_failures_once(spark):
    path = fresh_path(spark, "f")
    rows = spark.createDataFrame([("spec", "llm", "o/r", i, None, "e") for i in (1, 2)], schemas.FAILURES)
    told = lambda: sorted((r.run, r.stage, r.pr_id) for r in sinks.read_failures(spark, path).collect())
    for run in ("1", "2"):
        sinks.append_failures(rows, path, run, "spec")
    sinks.append_failures(rows, path, "1", "review")
    once = told()
    assert len(once) == 6
    sinks.append_failures(rows, path, "1", "spec")
    assert told() == once
    sinks.append_failures(rows.limit(0), path, "1", "spec")  # nothing failed this time
    assert told() == [t for t in once if t[:2] != ("1", "spec")]


def test_a_run_done_again_replaces_its_own_rows(spark):
    path = fresh_path(spark, "t")
    rows = spark.createDataFrame([("o", "a", 1), ("o", "b", 2)], "org string, repo string, number bigint")
    for run, part in (("1", rows), ("2", rows.filter("number = 2")), ("1", rows), ("2", rows.filter("number = 1"))):
        sinks.write_stage(part, path, run=run)
    read = spark.read.schema("org string, repo string, number bigint, run string").parquet(path)
    assert sorted((r.run, r.number) for r in read.collect()) == [("1", 1), ("1", 2), ("2", 1)]


def test_trees_are_written_and_read_by_commit(spark, tmp_path):
    rows = [("o/r", "c1", "doc/a.md", "# A\n"), ("o/r", "c2", "doc/a.md", "é"), ("o/q", "c1", "x y/z", "z"), ("o/q", "c3", "n", None)]
    table = spark.createDataFrame(rows, schemas.REPO_FILES)
    root = str(tmp_path / "tree")
    assert files.write_tree(table, root) == 3 and files.write_tree(table, root) == 3  # done again, the same files
    read = lambda commits=None: {tuple(r) for r in files.repo_files_scan(spark, root, commits).collect()}
    assert read() == set(rows[:3])
    some = files.repo_files_scan(spark, root, [("o/r", "c2"), ("o/q", "c1"), ("o/q", "c1"), ("o/q", "c9")])
    assert {tuple(r) for r in some.collect()} == set(rows[1:3])
    assert not any("/o/r/c1/" in f for f in some.inputFiles())
    assert read([]) == read([("none", "none")]) == set()
    with pytest.raises(Exception, match="not below its commit"):
        files.write_tree(spark.createDataFrame([("o/r", "c1", "../../up", "x")], schemas.REPO_FILES), root)


def test_trees_are_listed_in_tasks(spark, tmp_path):
    """No file index on the driver; empty and hidden files and folders are passed over as by file scans."""
    for at, name in (("o/r/c", "a.md"), ("o/r/c/_x=1", "b.md"), ("o/r/c/_h", "c.md"), ("o/r/.c", "d.md"), ("o/r/c", "_e.md"), ("o", "top.md")):
        _write(tmp_path / "tree" / at, name, "x")
    _write(tmp_path / "tree/o/r/c", "empty.md", "")
    found = files.repo_files_scan(spark, str(tmp_path / "tree"))
    assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.path for r in found.collect()) == ["_x=1/b.md", "a.md"]
    assert [r.path for r in files.misplaced_files(spark, str(tmp_path / "tree")).collect()] == ["o/top.md"]


def test_exported_tree(spark, tmp_path):
    sha = "a1" * 20
    _write(tmp_path / "tree/o/r" / sha / "doc/my dir", "a b.md", "# T\nx\n")
    _write(tmp_path / "tree/o/r" / sha, "top.v", "module t;")
    with open(tmp_path / "tree/o/r" / sha / "bin.dat", "wb") as f:
        f.write(b"\xff\xfe")
    rows = {tuple(r) for r in files.repo_files_scan(spark, str(tmp_path / "tree")).collect()}
    assert rows == {("o/r", sha, "doc/my dir/a b.md", "# T\nx\n"), ("o/r", sha, "top.v", "module t;"), ("o/r", sha, "bin.dat", None)}


def test_folder_names_do_not_matter(spark, tmp_path):
    root = tmp_path / "aa" / "bb" / "1234567" / "tree"
    _write(root / "org" / "rp" / "v1.0" / "doc", "x.md", "# T")
    _write(root / "org" / "rp", "loose.md", "# L")
    for given in (str(root), f"file://{root}/"):
        assert [tuple(r) for r in files.repo_files_scan(spark, given).collect()] == [("org/rp", "v1.0", "doc/x.md", "# T")]
        assert [r.path for r in files.misplaced_files(spark, given).collect()] == ["org/rp/loose.md"]


def test_repository_lists(spark):
    specs = spark.createDataFrame([(x,) for x in ("o/r", " o / q ", "none", "a/b/c")], "spec string")
    rows = {r.spec: (r.valid, r.org, r.repo) for r in repos.parse_repo_specs(specs).collect()}
    assert rows == {"o/r": (True, "o", "r"), " o / q ": (True, "o", "q"), "none": (False, None, None), "a/b/c": (True, "a", "b/c")}
    assert repos.default_repo_specs(spark).count() == len(fixed.DEFAULT_REPOS)
    assert repos.default_repo_config(spark).filter("size(doc_dirs) > 0").count() == 3


def test_names_from_files(spark):
    given = [("a_b__c__d_s01_01_prs.jsonl", None), ("x.jsonl", "o/r/z"), ("x.jsonl", "no"), ("o__r_s01_06_single_rtl_candidates.jsonl", "p/q")]
    rows = spark.createDataFrame([(i, *g) for i, g in enumerate(given)], "i int, f string, r string").orderBy("i")
    loose = [tuple(r[0]) for r in rows.select(repos.repo_from_filename(F.col("f"), F.col("r"))).collect()]
    assert loose == [("a_b__c", "d"), ("o", "r/z"), (None, None), ("o", "r")]
    strict = [tuple(r[0]) for r in rows.select(repos.repo_from_filename(F.col("f"), F.col("r"), candidate_file=True)).collect()]
    assert strict == [(None, None), ("o", "r/z"), (None, None), ("o", "r")]


def test_arrivals_take_each_key_once(spark):
    folder, sink, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "cp"))
    for name, text in (("1.json", '{"id": 1, "name": "a"}\noops\n{"id": 1, "name": "b"}\n'), ("2.json", '{"id": 1, "name": "late"}\n{"id": 2, "name": "c"}\n')):
        _write(folder, name, text)
        stream_dedup(spark, folder, SCHEMA, ["id"], sink, checkpoint).awaitTermination()
    rows = {r.id: r.name for r in spark.read.parquet(sink).collect()}
    assert set(rows) == {1, 2} and rows[1] in ("a", "b")


def test_arrivals_keep_no_state(spark):
    """Many arrivals: the sink holds each key once, and no query keeps state."""
    folder, sink, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "cp"))
    for k in range(6):
        _write(folder, f"{k}.json", "".join(f'{{"id": {i}, "name": "n{k}"}}\n' for i in range(k * 10, k * 10 + 30)) + '{"name": "no id"}\n')
        query = stream_dedup(spark, folder, SCHEMA, ["id"], sink, checkpoint)
        query.awaitTermination()
        assert not any(p["stateOperators"] for p in query.recentProgress)
    rows = [(r.id, r.name) for r in spark.read.parquet(sink).collect()]
    assert sorted(r[0] for r in rows if r[0] is not None) == list(range(80)) and len(rows) == 81
    assert dict(rows)[35] == "n1" and not os.path.isdir(os.path.join(checkpoint, "state"))


def test_a_batch_done_again_leaves_its_rows_once(spark):
    sink = fresh_path(spark, "out")
    batch = lambda *ids: spark.createDataFrame([(i, "x", None) for i in ids], SCHEMA)
    take_new(batch(1, 2, None), 0, sink, SCHEMA, ["id"])
    for _ in range(2):
        take_new(batch(2, 3, 3, None), 1, sink, SCHEMA, ["id"])
    assert sorted((r.batch, r.id or 0) for r in taken_records(spark, sink, SCHEMA).collect()) == [(0, 0), (0, 1), (0, 2), (1, 3)]


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_a_run_leaves_nothing_behind(spark):
    outer = materialised(spark.range(3), "outer")
    seen = []
    with pytest.raises(ValueError), run_scope(spark):
        seen.append(materialised(spark.range(5), "inner"))
        with run_scope(spark):
            seen.append(materialised(spark.range(7), "innermost"))
            assert seen[1].count() == 7
        assert seen[0].count() == 5
        raise ValueError
    folders = [os.path.dirname(f.removeprefix("file://")) for df in (outer, *seen) for f in df.inputFiles()[:1]]
    assert [os.path.isdir(f) for f in folders] == [True, False, False] and outer.count() == 3
