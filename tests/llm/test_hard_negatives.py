"""Hard negatives against brute force, over one shard and many, with odd rows; and walks that end early."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchloom.llm import hard_negatives as hn
from patchloom.llm.rows import table

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, positives=5, negatives=5):
    used = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * x) for x in vector]
        if math.sqrt(sum(x * x for x in v)) < 2 ** 28:
            used.append((i, v, label))
    out = []
    for a, (i, v, label) in enumerate(used):
        if i is None or i % 100:
            continue
        scores = [(sum(x * y for x, y in zip(v, w)), j, other) for b, (j, w, other) in enumerate(used) if b != a]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for ps, p, _ in [s for s in scores if s[2] == label][:positives]:
            band = [s for s in scores if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps][:negatives]
            out += [(i, p, k + 1, s[1], ps, s[0]) for k, s in enumerate(band)]
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema) if isinstance(rows, list) else rows
    got = hn.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got), key=repr)


def crowd(n, seed, width=8):
    """Clusters with near and exact copies, so that bands are full and ties common."""
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = heads[rng.integers(6)] + rng.normal(size=width) * rng.choice([0, 0.01, 0.3])
        rows.append((i, (v / np.linalg.norm(v) * rng.choice([0.5, 1, 1])).tolist(), int(rng.integers(4))))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many shards and blocks, short strides, few members at a time, several clusters
        for name, value in {"SHARD_BYTES": 4096, "SHARD_ROWS": 16, "STRIDE": 16, "MEMBERS": 2, "ANCHORS": 3, "CLUSTER": 2}.items():
            monkeypatch.setattr(hn, name, value)
    rows = crowd(1200, 3)
    got = found(spark, rows)
    assert got == plain(rows) and len({r[0] for r in got}) == 12 and len(got) > 100


def test_odd_rows(spark):
    v = [0.5, 0.25]
    rows = [(0, v, 1), (0, v, 1), (0, v, 2), (1, v, 1), (2, v, 3), (2, v, 3), (None, v, 1), (None, v, 4), (3, None, 1), (4, [0.5, None], 1),
            (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 2), (7, v, None), (8, [0.5], 2), (9, [], 2), (10, [0.4, 0.3, 0.2], 2),
            (100, [0.0, 0.0], 2), (200, [], 1), (300, [-0.5, -0.25], 1), (11, [1e30, 0.0], 2), (12, [9e5, 1.0], 1), (13, [9e5, 1.0], 2), (400, [9e5, 2.0], 1)]
    got = found(spark, rows)
    assert got == plain(rows) and {0, 100, 400} <= {r[0] for r in got}
    assert not any(4 in r[1:4:2] or 7 in r[1:4:2] or 11 in r[1:4:2] for r in got)
    more = [(*r, None, 1, "x") for r in rows]
    assert found(spark, more, SCHEMA + ", `row` string, norm int, cluster string") == got


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert found(spark, [(0, [1.0], 1)]) == [] and found(spark, [(0, None, 1), (100, [1.0], None)]) == []


def test_walks_end_when_certified():
    """Tight clusters: only the head of a list is scored, and the result is that of all rows."""
    rng = np.random.default_rng(5)
    heads = rng.normal(size=(40, 16))
    v = np.floor(256 * np.repeat(heads, 500, axis=0) / np.linalg.norm(heads, axis=1).repeat(500)[:, None] + rng.normal(size=(20_000, 16)))
    norm, labels = np.linalg.norm(v, axis=1), np.arange(20_000) % 3
    import pyarrow as pa

    shard = hn.Shard(np.arange(20_000), pa.array(np.arange(20_000)), labels, v, norm)
    who = np.arange(0, 500, 50)
    scored = []
    anchors = {"row": who, "label": labels[who], "v": v[who], "norm": norm[who]}
    walk = shard.walk

    def counted(v_, norm_, needs, meet):
        return walk(v_, norm_, needs, lambda part, at, scores: (scored.append(scores.size), meet(part, at, scores)))

    shard.walk = counted
    m, c, score = hn._positives(shard, anchors, 5)
    assert sum(scored) <= 2 * hn.STRIDE * len(who) < 0.3 * 20_000 * len(who)
    for k, a in enumerate(who.tolist()):
        every = sorted(((-int(v[a] @ v[b]), b) for b in np.flatnonzero(labels == labels[a]).tolist() if b != a))[:5]
        assert sorted(zip((-score[m == k]).tolist(), c[m == k].tolist())) == every


def test_whole_table(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings")
    assert found(spark, rows) == plain([(r.vec_id, r.embedding, r.label) for r in rows.collect()])
