import random
import re

from pyspark.sql import functions as F

from patchloom.catalog.registry import Tables
from patchloom.functions import diffs
from patchloom.operators import annotation
from patchloom.operators.patches import blocks_by_hunk, change_blocks, hunk_counts

_DIFFS = "org string, repo string, number bigint, diff_text string"


def _plain(diff):
    """Blocks by hunk, line by line: [[(line_start, line_end, added, removed), ...], ...]."""
    hunks, inside, lines = [], False, diff.split("\n")
    if lines[-1] == "":
        lines.pop()
    for line in lines:
        if line.startswith("diff --git "):
            inside, body = True, None
        elif inside and re.match(r"@@ -[0-9]", line):
            head = re.match(r"@@ -([0-9]+)(?:,[0-9]+)? \+[0-9]+(?:,[0-9]+)? @@", line)
            hunks.append((int(head[1]) if head else 1, body := []))
        elif inside and body is not None:
            body.append(line[:1])
    found = []
    for old, signs in hunks:
        blocks, block = [], None
        for sign in signs:
            if sign == "\\":
                continue
            if sign not in ("+", "-"):
                old, block = old + 1, None
                continue
            if block is None:
                blocks.append(block := [old, 0, 0])
            block[1 if sign == "+" else 2] += 1
            old += sign == "-"
        found.append([(at, at + gone - 1, new, gone) if gone else (max(at - 1, 0), max(at - 1, 0), new, gone) for at, new, gone in blocks])
    return found


def _diffs():
    rng = random.Random(7)
    starts = ["+", "-", " ", "\\", "", "+++ b/x", "--- a/y", "\\ No newline at end of file", "@@ x", "@@ -", "diff", "\r", "\x0b+", "é", " @@ -1 +1 @@"]
    weights = [9, 9, 9, 2, 2, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1]
    made = []
    for _ in range(150):
        text = rng.choice(["", "", "before\n@@ -1 +1 @@\n+x\n"])
        for f in range(rng.randint(0, 3)):
            text += f"diff --git a/f{f} b/f{f}\n" + rng.choice(["", f"--- a/f{f}\n+++ b/f{f}\n"])
            for _ in range(rng.randint(0, 3)):
                text += rng.choice(["@@ -0,0 +1,2 @@", "@@ -1 +1 @@ m", "@@ -17,3 +17,5 @@", "@@ -5 nothing"]) + "\n"
                text += "".join(s + rng.choice(["", "a", " b"]) + "\n" for s in rng.choices(starts, weights, k=rng.randint(0, 12)))
        made.append(text[:-1] if text and rng.random() < 0.3 else text)
    # more stretches than are placed one after the other, in one hunk
    made.append("diff --git a/f b/f\n@@ -3 +3 @@\n" + "".join(f"-a\n+b\n{c} c\n" for c in ["", "+d\n-e\n"] * 400))
    return made


def test_blocks_equal_a_walk_over_the_lines(spark):
    made = _diffs()
    rows = spark.createDataFrame([("o", "r", n, text) for n, text in enumerate(made)] + [("o", "r", -1, None)], _DIFFS)
    got = {r["number"]: r["blocks"] for r in blocks_by_hunk(rows).collect()}
    assert got.pop(-1) is None
    assert {n: [[tuple(b) for b in h] for h in blocks] for n, blocks in got.items()} == {n: _plain(text) for n, text in enumerate(made)}
    assert {r["number"]: r["hunks"] for r in hunk_counts(rows).collect()} == {-1: None} | {n: len(_plain(text)) for n, text in enumerate(made)}
    unfolded = sorted((r["number"], r["hunk_id"], r["line_start"], r["line_end"], r["added"], r["removed"]) for r in change_blocks(rows).collect())
    assert unfolded == sorted((n, f"HUNK_{k}", *b) for n, text in enumerate(made) for k, blocks in enumerate(_plain(text), 1) for b in blocks)


def test_notes_of_diffs_that_landed_twice(spark):
    note = '{"hunk_id": "%s", "bug_type": {"level1": "Functional Bug", "level2": "Data Flow Bug"}, "bug_desc": 3, "fix_hint": "h"}'
    content = '{"bug_info": [[%s], %s, [], null, 5]}' % (note % "HUNK_1", note % "HUNK_2")
    answers = [("o", "r", n, content) for n in (1, 2, 2, 3, 4, 5)] + [
        ("o", None, 6, content), ("o", "r", 7, "[]"), ("o", "r", 8, "{}"), ("o", "r", 9, None), ("o", "r", 10, '{"bug_info": []}')]
    one, two = ("diff --git a/f b/f\n" + "".join(f"@@ -{at} +1 @@\n-a\n" for at in starts) for starts in ((9, 4), (2,)))
    landed = [("o", "r", 1, one), ("o", "r", 2, one), ("o", "r", 3, one), ("o", "r", 3, two), ("o", "r", 4, None), ("o", None, 6, one)]
    notes = annotation.annotation_notes(spark.createDataFrame(answers, _DIFFS.replace("diff_text", "content")), spark.createDataFrame(landed, _DIFFS))
    assert notes.columns == ["number", "org", "repo", "hunk_id", "pos", "level1", "level2", "bug_desc", "fix_hint", "bug_lineno", "error"]
    named = notes.filter("hunk_id is not null").select("number", "pos", "hunk_id", F.array_join("bug_lineno", ","), "error", "bug_desc").collect()
    gone = "hunk not in the diff"
    expected = [(1, 0, "HUNK_1", "9,9", None), (1, 1, "HUNK_2", "4,4", None)] + 2 * [(2, 0, "HUNK_1", "9,9", None), (2, 1, "HUNK_2", "4,4", None)]
    # a note meets each of two diffs, whose ranges are put together, and is held against the hunks of either
    expected += 2 * [(3, 0, "HUNK_1", "2,2,9,9", None)] + [(3, 1, "HUNK_2", "4,4", None), (3, 1, "HUNK_2", "4,4", gone)]
    expected += [(n, k, f"HUNK_{k + 1}", None, gone) for n in (4, 5, 6) for k in (0, 1)]
    assert sorted(map(str, (tuple(r) for r in named))) == sorted(str((*e, None)) for e in expected)
    others = {(r["number"], r["error"]) for r in notes.filter("hunk_id is null").collect()}
    assert {(7, "answer has the wrong shape"), (8, "answer lists nothing"), (9, "answer has the wrong shape")} <= others
    assert not notes.filter("number = 10").count()


def test_a_scan_with_a_sketch_is_compiled(spark, sf_dir):
    """The virtual machine leaves methods of 8,000 bytes and more to its interpreter, where a row costs some twenty times as much."""
    t = Tables(spark, sf_dir)
    notes = annotation.annotation_notes(t.view("annotation_answers"), t.diffs())
    assert notes.collect()
    code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(notes._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_paths_are_told_from_plain_texts(spark):
    """Whether a diff is looked at at all is told of every diff; functions over arrays of structs cost several times what they do over texts."""
    made = {
        "": [], "x": [], "diff --git a/p b/p\nnew mode": ["p"], "diff --git nothing\n@@ -1 +1 @@\n": [""],
        "pre\ndiff --git a/p b/q\n--- a/p\n+++ /dev/null\n@@ -1 +0,0 @@\n-x\ndiff --git a/q b/q\n--- /dev/null\n+++ \"b/r s\"\t1\n": ["p", "r s"],
        "diff --git a/c b/c\n@@ -1 +1 @@\n+++ b/zz\n+y\ndiff --git --- a/k b/m\n+++ /dev/null\ndiff --git a/c b/c\n": ["c", "m"]}
    rows = spark.createDataFrame([("o", "r", n, text) for n, text in enumerate(made)] + [("o", "r", -1, None)], _DIFFS)
    found = rows.select("number", diffs.paths(F.col("diff_text")).alias("paths"))
    assert {r["number"]: r["paths"] for r in found.collect()} == {-1: None} | dict(enumerate(made.values()))
    assert "struct" not in found._jdf.queryExecution().optimizedPlan().toString()
