"""Scores against brute force over all pairs of a small fixture."""

import random
from collections import defaultdict

import pytest

from patchloom.operators import scoring


def _brute(bugs, reports):
    meets = lambda b, r: (
        None not in (*b, *r) and b[0] == r[0] and b[2] == r[2] and b[3] <= b[4] and r[3] <= r[4] and b[3] <= r[4] and b[4] >= r[3])
    met = {("report", *r): sum(meets(b, r) for b in bugs) for r in reports}
    met |= {("bug", *b): sum(meets(b, r) for r in reports) for b in bugs}
    counts = defaultdict(lambda: [set(), set(), set(), set(), set()])
    for r in reports:
        c = counts[r[0]]
        c[0].add(r[1])
        if met[("report", *r)]:
            c[1].add(r[1])
        if any(None not in (r[0], r[2]) and b[0] == r[0] and b[2] == r[2] for b in bugs):
            c[2].add(r[1])
    for b in bugs:
        c = counts[b[0]]
        c[3].add(b[1])
        if met[("bug", *b)]:
            c[4].add(b[1])
    return met, {t: tuple(len(s) for s in c) for t, c in counts.items()}


def _random_rows(seed, n, hot):
    rng = random.Random(seed)
    rows = set()
    for i in range(n):
        # A third of all rows belongs to one task and file.
        task, file = (0, "hot.sv") if rng.random() < hot else (rng.randrange(6), f"f{rng.randrange(3)}.sv")
        start = rng.randrange(60)
        end = start + rng.randrange(-2, 9)
        missing = rng.randrange(20)
        rows.add((None if missing == 0 else task, i // 2, None if missing == 1 else file,
                  None if missing in (2, 3) else start, None if missing in (3, 4) else end))
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_and_counts_equal_brute_force(spark, seed):
    bugs, reports = _random_rows(seed, 300, 0.34), _random_rows(seed + 50, 400, 0.34)
    met, counts = _brute(bugs, reports)
    b = spark.createDataFrame(bugs, "task_id int, bug_id int, file string, line_start bigint, line_end bigint")
    r = spark.createDataFrame(reports, "task_id int, report_id int, file string, line_start bigint, line_end bigint")
    found = scoring.overlap_match(b, r).collect()
    assert {(x.side, x.task_id, x.id, x.file, x.line_start, x.line_end): x.met for x in found} == met
    rows = {x.task_id: tuple(x)[1:] for x in scoring.score_counts(b, r).collect()}
    assert rows == counts


def test_scores(spark):
    bugs = [(1, 1, "a", 5, 9), (1, 2, "a", 50, 50), (2, 3, "b", 1, 2)]
    reports = [(1, 1, "a", 9, 12), (1, 2, "a", 20, 30), (1, 3, "x", 5, 9), (1, 4, "a", 6, 6), (3, 5, "c", 1, 1)]
    b = spark.createDataFrame(bugs, "task_id int, bug_id int, file string, line_start bigint, line_end bigint")
    r = spark.createDataFrame(reports, "task_id int, report_id int, file string, line_start bigint, line_end bigint")
    rows = {(x.scope, x.task_id): x for x in scoring.score(b, r).collect()}
    one = rows[("task", 1)]
    assert (one.line_precision, one.file_accuracy, one.recall, one.f1) == (0.5, 0.75, 0.5, 0.5)
    assert one.weighted_score == pytest.approx(0.5 * 0.2 + 0.75 * 0.05 + 0.5 * 0.2 + 0.5 * 0.1)
    two, three, pooled = rows[("task", 2)], rows[("task", 3)], rows[("pooled", None)]
    assert (two.line_precision, two.file_accuracy, two.recall, two.f1, two.weighted_score) == (None, None, 0.0, None, 0.0)
    assert (three.line_precision, three.recall, three.f1) == (0.0, None, None)
    assert (pooled.line_precision, pooled.recall) == (0.4, pytest.approx(1 / 3))


def test_reports_without_a_place_count_as_reports(spark):
    bugs = [(1, 1, "a", 5, 9)]
    reports = [(1, 1, "a", 6, 7), (1, 2, "a", None, None), (1, 3, None, 5, 9), (1, 4, "a", 5, None)]
    b = spark.createDataFrame(bugs, "task_id int, bug_id int, file string, line_start bigint, line_end bigint")
    r = spark.createDataFrame(reports, "task_id int, report_id int, file string, line_start bigint, line_end bigint")
    row = scoring.score(b, r).filter("scope = 'task'").first()
    assert (row.reports, row.line_precision, row.file_accuracy, row.recall) == (4, 0.25, 0.75, 1.0)
