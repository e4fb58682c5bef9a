"""SimHash near-duplicates by anchor points.

A document is a 64-bit fingerprint: bit i is set where over half of the hashes of its shingles
have bit i set. Equal fingerprints fall together first, so exact copies cost one row each from
then on. Two fingerprints link where at most ``distance`` bits differ.

Candidate search: two fingerprints with at most three differing bits have a half of 32 bits with
at most one. Each half is searched with a covering code as anchors: the perfect Hamming code on
31 bits (every word has a code word within one bit) beside the plain 32nd bit, 2**27 anchors with
covering radius R = 1. Every fingerprint is copied to all anchors of its half within R + 1 bits,
2 for a code word and 17 for any other. If x and y differ in at most one bit of the half and c is
the anchor nearest to x, then c lies within R + 1 of both: they meet at c, where all 64 bits are
compared. No link is missed, and the anchors stay small however many fingerprints there are.

An anchor with very many fingerprints (a crowd of near copies) is dealt out in blocks, every pair
of blocks to a bucket of its own, so a task holds two blocks at most at a time. Buckets hand on
only what connects their members (a root for each), never all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.components import components
from patchloom.llm.rows import col, with_text_columns
from patchloom.llm.words import let_go
from patchloom.session import materialised

#: Fingerprints of one anchor that are compared in one place; more are dealt out in blocks of this size.
BLOCK = 2048
#: Links held before they are folded into roots.
_HELD = 1 << 19


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of the shingles of a text, repeats included; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    if n == 1:
        spans = [(0, len(joined))]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        spans = zip((ends - sizes)[:n].tolist(), (ends[shingle - 1:] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], 42) for s, e in spans], dtype="<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text; 0 without words."""
    return _majority(shingle_hashes(text, shingle))


def _majority(hashes: np.ndarray) -> int:
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[i: i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprint_column(shingle: int):
    def work(texts: pa.Array) -> list:
        return [pa.array(np.array([fingerprint(t, shingle) for t in texts.to_pylist()], dtype=np.uint64).view(np.int64))]

    def make():
        let_go()
        return work

    return make


# The Hamming code on 31 bits: position p (1 to 31) adds p to the syndrome; code words have syndrome 0.
def _syndrome(x: np.ndarray) -> np.ndarray:
    s = np.zeros(len(x), dtype=np.int64)
    for p in range(1, 32):
        s ^= np.where(x >> (p - 1) & 1, p, 0)
    return s


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, anchor) for all anchors within two bits of each 32-bit word."""
    low, top = half & 0x7FFFFFFF, half & 0x80000000
    s = _syndrome(low)
    index, found = [], []

    def add(which, code, flip):
        index.append(which)
        found.append(code | (top[which] ^ (0x80000000 if flip else 0)))

    at = np.flatnonzero(s == 0)
    for flip in (False, True):
        add(at, low[at], flip)
    off = np.flatnonzero(s)
    nearest = low[off] ^ (1 << (s[off] - 1))
    for flip in (False, True):
        add(off, nearest, flip)
    for p in range(1, 32):  # two bits p < q with p xor q = syndrome
        q = s[off] ^ p
        at = off[q > p]
        add(at, low[at] ^ (1 << (p - 1)) ^ (1 << ((s[at] ^ p) - 1)), False)
    return np.concatenate(index), np.concatenate(found)


_ENTRY = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("f", T.LongType())])
_EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, len(batch), 20_000):
            f = batch.column(0).slice(i, 20_000).to_numpy()
            for side, half in enumerate((f & 0xFFFFFFFF, f >> 32 & 0xFFFFFFFF)):
                at, code = anchors(half)
                yield pa.RecordBatch.from_arrays([pa.array(code | side << 32), pa.array(f[at])], names=["anchor", "f"])


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links folded into one link per member and its root."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a):]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        root = root[root]
        if (root == before).all():
            break
    own = root != np.arange(len(names))
    return names[own], names[root[own]]


def _buckets(within):
    """Links of ``within`` for runs of equal (anchor, block pair), read in order; a run may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(3)]
            if left is not None:
                columns = [np.concatenate(x) for x in zip(left, columns)]
            change = np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])) + 1
            key = np.zeros(len(columns[0]), dtype=np.int64)
            key[change] = 1
            key = np.cumsum(key)  # a number for each run
            cut = int(change[-1]) if len(change) else 0
            if cut:
                for a, b in within(key[:cut], *[c[:cut] for c in columns[2:]]):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            left = [c[cut:] for c in columns]
        if left is not None and len(left[0]):
            for a, b in within(np.zeros(len(left[0]), dtype=np.int64), *left[2:]):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _linked(near):
    """Roots of the links inside runs of equal ``key``, every two members being held against each other by ``near``."""

    def within(key: np.ndarray, f: np.ndarray, *more: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        end = np.repeat(np.r_[start[1:], len(key)], np.diff(np.r_[start, len(key)]))
        at, lag, held = np.arange(len(key)), 0, []
        while True:
            lag += 1
            at = at[at + lag < end[at]]
            if not len(at):
                break
            pair = at[near(at, at + lag, f, *more)]
            held.append((f[pair], f[pair + lag]))
            if sum(len(x) for x, _ in held) > _HELD:
                held = [_roots(*(np.concatenate(x) for x in zip(*held)))]
        if held:
            yield _roots(*(np.concatenate(x) for x in zip(*held)))

    return within


def _few_bits(distance: int):
    return lambda i, j, f: np.bitwise_count((f[i] ^ f[j]).view(np.uint64)) <= distance


def _pairs_of_blocks(blocks: Column) -> Column:
    """The buckets of value ``f`` in a crowd dealt out in ``blocks``: the pairs (i, j) of its block i and every j, so each two blocks meet once."""
    i = F.pmod(F.xxhash64("f"), blocks)
    return F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.least(i, j) * blocks + F.greatest(i, j))


def links(fingerprints: DataFrame, distance: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` between distinct 64-bit values (column ``f``, as signed longs) that connect exactly what pairs
    with at most ``distance`` (3 or fewer) differing bits connect. Not all pairs are listed."""
    if not 0 <= distance <= 3:
        raise ValueError("the anchors cover up to three differing bits")
    spark = fingerprints.sparkSession
    entries = fingerprints.select("f").mapInArrow(_entries, _ENTRY)
    sizes = entries.groupBy("anchor").agg(F.count("*").alias("n"))
    crowded = materialised(sizes.filter(F.col("n") > block).select("anchor", F.ceil(F.col("n") / block).alias("blocks")), "crowded")
    if crowded.isEmpty():
        dealt = entries.select("anchor", F.lit(0).cast("long").alias("pair"), "f")
    else:
        many = entries.join(crowded, "anchor", "left")
        pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(_pairs_of_blocks(F.col("blocks")))
        dealt = many.select("anchor", F.explode(pairs).alias("pair"), "f")
    return (
        dealt.repartition("anchor", "pair").sortWithinPartitions("anchor", "pair", "f")
        .mapInArrow(_buckets(_linked(_few_bits(distance))), _EDGE).distinct()
    )


def groups(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3, block: int = BLOCK,
) -> DataFrame:
    """``doc_id``, fingerprint ``f`` (signed long), ``root`` (the least fingerprint of the component) and ``component_id``
    (the smallest id in it) of every row.

    Null and empty texts have fingerprint 0 and link like any other. A text is read whole, however long. Repeated rows come out as often as they
    stand. A null id never becomes a component id unless its component has no other. Ids keep their type. An empty table gives none.
    """
    marked = with_text_columns(documents, text, [doc_id], [T.StructField("f", T.LongType())], _fingerprint_column(shingle))
    marked = materialised(marked.select(F.col("row")[doc_id].alias("doc_id"), "f"), "fingerprints")
    distinct = materialised(marked.groupBy("f").agg(F.min("doc_id").alias("least")), "distinct")
    of = components(links(distinct, distance, block)).withColumnRenamed("node", "f")
    rooted = distinct.join(of, "f", "left").withColumn("root", F.coalesce("root", "f"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.select("f", "root").join(least, "root"), "f").select("doc_id", "f", "root", "component_id")


def near_duplicates(documents: DataFrame, **settings) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row; see ``groups``."""
    return groups(documents, **settings).select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def kept_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of each component, that of the smallest id (null last), all columns as they were, whatever their names.

    Where ids are unique, rows leave by their id alone. Rows that share an id, or have none, are told apart by their
    fingerprint as well; of equal ones any single row stays. Null and empty texts are one component. An empty table stays empty.
    """
    rows = materialised(groups(documents, doc_id, text, **settings), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "f")
    kept = rows.groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", "k.f")
    odd = materialised(rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select("doc_id"), "odd")
    gone = rows.filter("doc_id <> component_id").select("doc_id").unionAll(odd).distinct()
    # the documents ride in a struct, so that none of their names meets one of these
    own = documents.select(F.struct(*[col(c).alias(c) for c in documents.columns]).alias("row"))
    key = F.col("row").getField(doc_id)
    out = own.join(gone, key.eqNullSafe(F.col("doc_id")), "left_anti").select("row.*")
    if odd.isEmpty():
        return out
    some = own.join(odd, key.eqNullSafe(F.col("doc_id")), "left_semi").select("row.*")
    some = with_text_columns(some, text, documents.columns, [T.StructField("f", T.LongType())], _fingerprint_column(settings.get("shingle", 3)))
    some = some.select("row", "f", F.col("row").getField(doc_id).alias("key"))
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("f").alias("kept_f"))
    some = some.join(kept, F.col("key").eqNullSafe(F.col("kept_id")) & (F.col("f") == F.col("kept_f")), "left_semi")
    return out.unionAll(some.dropDuplicates(["key", "f"]).select("row.*"))
