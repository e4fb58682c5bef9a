"""Importance resampling towards a target text, by hashed n-gram features.

A feature is a run of 1 to ``most`` words; it falls into a bucket by its CRC-32. The gain of a bucket says how much
commoner it is in the target than in the raw documents; a document's weight is the sum of the gains of its features,
and the highest weights after adding a Gumbel number drawn by id make a sample without replacement that looks like the target.

Inside a task the n-grams of a batch of texts are interned in an open-addressed NumPy table (``interning``): slots store
bucket and count, and every occurrence keeps its slot id. The first pass adds up the counts of the slots by bucket, one row per bucket and
task; the second gathers a gain for each occurrence through its slot id. Texts never leave their task: what is shuffled is a number
per bucket and task, and narrow rows for the ranks. Ranks come from a range-partitioned order, in no single task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.decontamination import Words
from patchloom.llm.interning import Grams
from patchloom.llm.rows import SLICE_BYTES, col, slices, with_text_columns
from patchloom.llm.running import running_totals
from patchloom.session import materialised

#: Buckets of features, and the longest run of words that makes one.
BUCKETS, MOST = 10_000, 3


def parts(texts: pa.Array, most: int, limit: int = SLICE_BYTES) -> Iterator[tuple[Words, int]]:
    """The words of a slice of texts with a sign. A slice is taken at once; a single text of more than ``limit`` bytes is taken in
    parts that begin with the last words of the part before, and these words alone are taken away again (sign -1), so that every run of words counts once."""
    if len(texts) != 1 or not texts[0].is_valid or len(texts[0].as_buffer()) <= limit:
        yield Words(texts), 1
        return
    text, start, carry = texts[0].as_py(), 0, ""
    while start < len(text):
        end = min(start + limit, len(text))
        while end < len(text) and (text[end].isalnum() or ord(text[end]) > 127):
            end += 1
        words = Words(pa.array([carry + " " + text[start:end]], pa.string()))
        yield words, 1
        if carry:
            yield Words(pa.array([carry], pa.string())), -1
        last = max(len(words.start) - most + 1, 0)
        carry = words.text(last, most - 1).decode() if most > 1 else ""
        start = end


def _slot_counts(most: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0)
            for start, length in slices(texts):
                for words, sign in parts(texts.slice(start, length), most):
                    grams = Grams(words, most, buckets)
                    used = np.flatnonzero(grams.count)
                    np.add.at(total, grams.bucket[used], sign * grams.count[used])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(rows: DataFrame, text: str = "text", most: int = MOST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. Null, empty and wordless texts have none; an empty table gives zeros.

    At most ``buckets`` rows come to the driver."""
    found = (
        rows.select(col(text).cast("string").alias("text")).mapInArrow(_slot_counts(most, buckets), "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    out = np.zeros(buckets, dtype=np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths of a natural logarithm, rounded down; every bucket counts one feature more than it has."""
    n = float(len(raw))
    s_all, t_all = float(raw.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
        for s, t in zip(raw.astype(float).tolist(), target.astype(float).tolist())
    ], dtype=np.int64)


def weighed(documents: DataFrame, gain: np.ndarray, keep: list[str], text: str = "text", most: int = MOST) -> DataFrame:
    """``row`` (the kept columns), ``n_words``, ``n_features`` and ``weight`` of every row. Without words all are 0.

    A very long text is worked on in parts of bounded size; its weight is that of the whole.
    """
    fields = [T.StructField(name, T.LongType()) for name in ("n_words", "n_features", "weight")]

    def make():
        def work(texts: pa.Array) -> list:
            n = len(texts)
            out = np.zeros((3, n), dtype=np.int64)
            for words, sign in parts(texts, most):
                grams = Grams(words, most, len(gain))
                out[0] += sign * np.bincount(words.row, minlength=n)
                out[1] += sign * np.bincount(grams.row, minlength=n)
                # sums of whole numbers, exact in doubles
                out[2] += sign * np.bincount(grams.row, weights=gain[grams.bucket[grams.slot]], minlength=n).astype(np.int64)
            return [pa.array(x) for x in out]

        return work

    return with_text_columns(documents, text, keep, fields, make)


def gumbel(doc_id: Column, seed: int = 42) -> Column:
    """A Gumbel number drawn by id, in thousandths, rounded down. A null id draws like an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resampled(
    documents: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    least_words: int = 20, percent: int = 5, most: int = MOST, buckets: int = BUCKETS, seed: int = 42,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``documents``.

    Of the N rows with at least ``least_words`` words those with the floor(percent * N / 100) highest scores get a rank from 1 on, ties by the
    smaller id (null last); the others have a null rank. Rows that repeat an id have its Gumbel number each and rank one after
    the other. Null, empty and wordless texts have weight 0 and are never drawn. An empty target makes all gains but those of rounding equal;
    an empty table of documents gives an empty result. Other columns, whatever their names, are not read.
    """
    gain = gains(bucket_counts(documents, text, most, buckets), bucket_counts(target, target_text, most, buckets))
    found = weighed(documents.select(col(doc_id).alias("doc_id"), col(text).alias("text")), gain, ["doc_id"], most=most)
    scored = materialised(found.select(
        F.col("row")["doc_id"].alias("doc_id"), "n_words", "n_features", "weight",
        (F.col("weight") + gumbel(F.col("row")["doc_id"], seed)).alias("score"),
    ), "scored")
    fit = F.col("n_words") >= least_words
    drawn = percent * scored.filter(fit).count() // 100
    one = scored.filter(fit).withColumn("group", F.lit(0)).withColumn("one", F.lit(1).cast("long"))
    placed = running_totals(one, "group", [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "one", "before")
    rank = F.when(F.col("before") < drawn, F.col("before") + 1).cast("long").alias("rank")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return placed.select(*columns, rank).unionAll(
        scored.filter(~fit).select(*columns, F.lit(None).cast("long").alias("rank")))
