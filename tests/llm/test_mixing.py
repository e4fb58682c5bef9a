"""Mixing: targets against plain sharing, words near the targets, certain copies, unequal probabilities, odd rows."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from patchloom.llm import mixing
from patchloom.llm.rows import table


def plain_targets(sizes, weights=(5, 2, 1), budget=1.5, limit=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = budget * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in held]
        level = (total - sum(limit * sizes[s] for s in held)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in held else weight[s] * level for s in names}
        held |= over


def check(rows, sizes, largest):
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sizes[r.source]
    targets = plain_targets(sizes)
    for s, target in targets.items():
        assert {round(r.target, 6) for r in rows if r.source == s} == {round(target, 6)}
        assert abs(taken[s] - target) <= largest[s] / 2 + 1e-6


def test_whole_table_near_its_targets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mixed(docs).collect()
    sizes, largest = Counter(), defaultdict(int)
    for r in docs.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    assert len(rows) == docs.count()
    check(rows, sizes, largest)
    assert sorted(map(str, mixing.mixed(docs.repartition(5)).collect())) == sorted(map(str, rows))


def test_odd_rows(spark):
    data = [(1, "a b c", "s", 1), (1, "a b c", "s", 1), (None, "x y", "s", 2), (2, None, "s", 3), (3, "", None, 4), (4, "one two " * 50_000, None, 5),
            (5, " \t\n ", "empty", 6), (6, "q" * 10_000, "Z", 7), (7, "é è", "é", 8)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, size long")
    rows = mixing.mixed(df).collect()
    sizes = {"s": 8, None: 100_000, "empty": 0, "Z": 1, "é": 1}
    assert len(rows) == len(data)
    check(rows, sizes, defaultdict(lambda: 100_000, {"s": 3, "Z": 1, "é": 1, "empty": 0}))
    assert mixing.mixed(df.limit(0)).collect() == []
    nothing = mixing.mixed(df.filter("doc_id in (2, 3, 5)")).collect()
    assert [(r["size"], r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 3


def test_one_source_many_copies(spark):
    """A single source: 1.5 copies of everything, one for certain."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("w w w w").alias("text"), F.lit("only").alias("source"))
    copies = Counter(r.taken // 4 for r in mixing.mixed(df).collect())
    assert copies == {1: 2000, 2: 2000}


def test_preferences_change_probabilities(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("w w").alias("text"), F.lit("only").alias("source"))
    wish = F.when(F.col("doc_id") % 3 == 0, 4.0).otherwise(1.0)
    rows = mixing.mixed(df, preference=wish, budget=0.6).collect()
    by = Counter((r.doc_id % 3 == 0, r.taken // 2) for r in rows)
    assert {round(r.copies, 3) for r in rows} == {1.2, 0.3}
    assert abs(sum(r.taken for r in rows) - 3600) <= 1
    assert by[(True, 0)] == 0 and 140 <= by[(True, 2)] <= 260 and 530 <= by[(False, 1)] <= 670


def test_preferences_stay_at_the_limit(spark):
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("w w").alias("text"), F.lit("only").alias("source"))
    rows = mixing.mixed(df, preference=F.when(F.col("doc_id") % 3 == 0, 100.0).otherwise(1.0)).collect()
    assert {round(r.copies, 6) for r in rows} == {2.0, 1.25} and abs(sum(r.taken for r in rows) - 2700) <= 1


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1}, {"a": 7, None: 3, "b": 7, "c": 7, "d": 100}, {"x": 5}, {"a": 0, "b": 4}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))
