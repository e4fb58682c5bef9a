"""Fingerprints, links and components against plain versions."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from patchloom.llm import near_duplicates as nd
from patchloom.llm.components import components


def plain_fingerprint(text, k=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i: i + k]) for i in range(max(len(w) - k + 1, 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["A", "b", "é ", " ", "\n", " ", "c\t", "xyz "]) for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += [None, "", "one", "one two", "one two three", "a b c " * 5000]
    assert [nd.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert [nd.fingerprint(t, 5) for t in texts] == [plain_fingerprint(t, 5) for t in texts]
    # the same hash as Spark's own
    assert spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0] == signed(nd.fingerprint("one two three"))


def test_anchors_cover_every_close_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, 3000)
    i, a = nd.anchors(x)
    assert set(np.bincount(i).tolist()) <= {2, 17}
    mine = {k: set(a[i == k].tolist()) for k in range(60)}
    for k in range(60):
        assert len(mine[k]) in (2, 17)
        assert all(bin(int(x[k]) ^ c).count("1") <= 2 for c in mine[k])
        for bit in range(32):  # a word one bit away shares an anchor
            j, b = nd.anchors(np.array([x[k] ^ (1 << bit)]))
            assert mine[k] & set(b.tolist())


@pytest.mark.parametrize("block", [4096, 20])
def test_links_connect_what_all_pairs_connect(spark, block):
    rng = random.Random(block)
    seeds = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    values = set(seeds)
    for s in seeds:  # chains and crowds around each seed
        x = s
        for _ in range(rng.choice([2, 10, 60])):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6)))
            values.add(x)
            values.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    values = sorted(values)
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if bin(a ^ b).count("1") <= 3]
    expected = plain_components(pairs, values)
    edges = nd.links(spark.createDataFrame([(signed(v),) for v in values], "f long"), block=block).collect()
    found = plain_components([(e.a & (1 << 64) - 1, e.b & (1 << 64) - 1) for e in edges], values)
    assert found == expected
    assert len(set(expected.values())) < len(values)


@pytest.mark.parametrize("crowd", [1000, 4])  # at 4, hubs are joined apart
def test_components(spark, crowd):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(501, 700)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)]
    pairs += [(1900, i) for i in range(1000, 1200)] + [(1500, i) for i in [*range(1300, 1400), *range(1600, 1700)]]
    pairs += [(7, 7), pairs[0], (None, 3)]
    real = [p for p in pairs if None not in p and p[0] != p[1]]
    out = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), crowd=crowd).collect()}
    assert out == plain_components(real, {n for p in real for n in p})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(rng):
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) for _ in range(400)) for _ in range(25)]
    rows = []
    for i in range(160):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(400)] = "changed"
        rows.append((1000 - i, " ".join(w), f"s{i % 3}"))
    return [*rows, (2000, None, None), (2001, "", "x"), (2002, " \n", "y"), (2003, "one", None)]


def expected_of(rows, shingle=3):
    prints = {plain_fingerprint(t, shingle) for _, t, _ in rows}
    pairs = [(a, b) for a in prints for b in prints if a < b and bin(a ^ b).count("1") <= 3]
    return plain_components(pairs, prints)


def test_rows(spark):
    rows = near_texts(random.Random(4))
    rows += [rows[0], (None, rows[1][1], None), (None, "stands alone", None)]
    roots = expected_of(rows)
    least = {}
    for i, t, _ in rows:
        r = roots[plain_fingerprint(t)]
        least[r] = min(x for x in (least.get(r), i, 1 << 60) if x is not None)
    expected = sorted(((i, f"{plain_fingerprint(t):016x}", None if least[roots[plain_fingerprint(t)]] == 1 << 60 else least[roots[plain_fingerprint(t)]])
                       for i, t, _ in rows), key=str)
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    assert sorted((tuple(r) for r in nd.near_duplicates(df).collect()), key=str) == expected
    assert nd.near_duplicates(df.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    rows = near_texts(random.Random(5))
    df = spark.createDataFrame(rows, "doc_id long, text string, f string")
    roots = expected_of(rows, 5)
    first = {}
    for row in sorted(rows):
        first.setdefault(roots[plain_fingerprint(row[1], 5)], row)
    kept = nd.kept_documents(df, shingle=5)
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(first.values())
    # shared and missing ids: one row of each component all the same
    odd = [*rows[:40], *rows[:5], (rows[0][0], "another text under the same id", "q"), (None, rows[2][1], "n"), (None, "only one without an id", "n"),
           (None, "only one without an id", "n")]
    roots = expected_of(odd, 5)
    out = nd.kept_documents(spark.createDataFrame(odd, df.schema), shingle=5).collect()
    assert sorted(roots[plain_fingerprint(r.text, 5)] for r in out) == sorted(set(roots.values()))
    assert not any(r.doc_id is None and r.text == rows[2][1] for r in out)


def test_any_column_names_stay(spark):
    names = ["doc_id", "text", "__gone", "__odd", "row", "f", "key", "kept_id", "root", "a.b"]
    rows = [(1, "one two three four", *range(8)), (2, "one two three four", *range(8)), (2, "other", *range(8)), (None, None, *range(8)), (3, "", *range(8))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names[2:]))
    out = nd.kept_documents(df)
    assert out.columns == names
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([rows[0], rows[2], rows[4]], key=str)
