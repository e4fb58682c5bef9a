"""Winnowed benchmark windows against plain word-by-word search."""

import hashlib
import random
import re

import duckdb
import pytest
from helpers import canonical

from patchloom.llm import decontamination, queries
from patchloom.llm.decontamination import benchmark_overlap, clean_documents, digest

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        v = words(t)
        for k in [v[s: s + 10] for s in range(max(len(v) - 9, 1))] if v else []:
            for s in range(len(w) - len(k) + 1):
                if w[s: s + len(k)] == k:
                    hit.update(range(s, s + len(k)))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def made(spark, documents, items, **settings):
    d = spark.createDataFrame(documents, "doc_id long, text string, n_words string, items string")
    b = spark.createDataFrame(items, "item_id long, text string, spans string")
    rows = digest(benchmark_overlap(d, b, ["doc_id"], **settings)).collect()
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows]


@pytest.mark.parametrize("sketch_bytes", [1 << 20, 64])  # the small one is full: it lets everything through
def test_equals_plain_search(spark, sketch_bytes):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice(["A", "b", "é", "12", "Ab"]) + rng.choice([" ", ", ", "\n", "  ", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 25])), "x") for i in range(20)] + [(90, None, None), (91, "", None), (92, "!?", None)]
    items.append((3, items[0][1], "again"))
    documents = [(i, text(rng.randrange(60)) + (rng.choice(items)[1] or "") + " " + text(rng.randrange(9)), None, "y") for i in range(120)]
    documents += [(500, None, None, None), (501, "", "a", "b"), (None, items[4][1], None, None), documents[0], documents[0]]
    expected = [(d[0], *plain(d[1], [(i, t) for i, t, _ in items])) for d in documents]
    key = lambda r: tuple(map(str, r))
    assert sorted(made(spark, documents, items, sketch_bytes=sketch_bytes), key=key) == sorted(expected, key=key)


def test_long_spans_only_for_long_items(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdef") * rng.randint(1, 3) for _ in range(n))
    items = [(i, text(40), None) for i in range(30)]
    documents = []
    for i in range(60):
        w = items[rng.randrange(30)][1].split()
        s, n = rng.randrange(30), rng.randrange(5, 16)
        documents.append((i, text(rng.randrange(300)) + " " + " ".join(w[s: s + n]) + " " + text(rng.randrange(300)), None, None))
    documents.append((99, text(30_000), None, None))
    expected = [(d[0], *plain(d[1], [(i, t) for i, t, _ in items])) for d in documents]
    assert sorted(made(spark, documents, items)) == sorted(expected)


def test_a_passage_in_most_documents(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    items = [(1, passage, None), (2, passage, None), (3, "w0 w1", None), (None, passage + " end", None)]
    documents = [(i, f"d{i} {passage if i % 3 else 'w0 w1'} z{i} {passage if i % 5 == 0 else ''}", None, None) for i in range(900)]
    expected = [(d[0], *plain(d[1], [(i, t) for i, t, _ in items if i])) for d in documents]
    assert sorted(made(spark, documents, items, salts=4)) == sorted(expected)


def test_clashing_names(spark):
    names = ["row", "id", "shared", "salt", "mark", "k", "words", "at", "items", "spans", "text"]
    d = spark.createDataFrame([tuple(range(10)) + ("a b c",), tuple(range(10)) + ("q",)], ", ".join(f"{n} {'string' if n == 'text' else 'long'}" for n in names))
    b = spark.createDataFrame([(1, "B c", "x")], "item_id long, text string, id string")
    assert [r.text for r in clean_documents(d, b).collect()] == ["q"]
    found = {r.row.text: (r.row.id, [tuple(s) for s in r.spans], r["items"]) for r in benchmark_overlap(d, b, names).collect()}
    assert found == {"a b c": (1, [(1, 3)], ["1"]), "q": (1, [], [])}


def test_full_sketch_is_bounded(spark):
    b = spark.createDataFrame([(i, " ".join(f"x{i}y{j}" for j in range(60))) for i in range(200)], "item_id long, text string")
    windows = b.selectExpr("cast(item_id as string) item_id", "text").mapInArrow(decontamination._windows(10, 5), decontamination._WINDOWS)
    assert windows.count() == 200 * 51
    assert decontamination._sketch(windows, 1024).nbytes == 1024
    assert 64 * 200 * 51 <= 8 * decontamination._sketch(windows, 1 << 25).nbytes < 2 * 64 * 200 * 51


def test_empty_tables(spark):
    assert made(spark, [], [(1, "a b", None)]) == []
    assert made(spark, [(1, "a b", None, None)], []) == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]


def test_clean_documents_keep_their_columns(spark):
    d = spark.createDataFrame([(1, "x one two three y", "a"), (2, "nothing", "b"), (3, None, None)], "doc_id long, text string, spans string")
    b = spark.createDataFrame([(1, "One two THREE")], "item_id long, text string")
    rows = clean_documents(d, b).collect()
    assert [tuple(r) for r in rows] == [(2, "nothing", "b"), (3, None, None)] and rows[0].__fields__ == d.columns


@pytest.mark.parametrize("name", sorted(queries.TWINS))
def test_query_equals_its_twin(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        duck.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    result = queries.QUERIES[name](spark, sf_dir)
    answer = duck.execute(queries.TWINS[name])
    assert canonical(result.columns, result.collect()) == canonical([c[0] for c in answer.description], answer.fetchall())
