"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters, digits and non-ASCII characters, ASCII upper case folded.
A benchmark item is a set of windows of ``window`` consecutive words (an item of fewer words
is one window). Of the ``window - gram + 1`` word-gram hashes inside a window, winnowing keeps
the smallest, the rightmost of equals. A window that occurs in a document has the same words
there, so the same hash is kept: each shared window meets in at least one fingerprint. The hits
are then extended to their windows and compared word by word, so the result is exact.

Both sides are tables of fingerprints. The benchmark's windows are written once; a Bloom filter of
them, of bounded size whatever the benchmark holds, goes to the executors and drops nearly all
windows of the documents inside the scan. What passes (hash, words, places, a row number) is joined
with the benchmark's windows on hash and words, in two steps: the distinct windows of all documents
meet the benchmark, and the few that are an item's go back to their documents, salted, so that a
passage which a third of the documents hold is spread over tasks. Texts are not shuffled, but for
documents that pass the filter where whole rows are asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.hashing import mixed, run_hashes
from patchloom.llm.rows import bounded_batches, col, slices, utf8
from patchloom.llm.words import let_go
from patchloom.session import materialised

#: The largest Bloom filter of benchmark windows, in bytes; beyond 64 bits a window more documents pass it, and the join decides as before.
SKETCH_BYTES = 32 << 20

#: Tasks over which the documents that hold one window are spread.
SALTS = 32

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of some texts: their row, their place in the folded bytes, and a hash of each."""

    def __init__(self, texts: pa.Array):
        data, bounds = utf8(texts)
        self.bytes = _FOLD[data]
        inside = _WORD[self.bytes]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        edges = bounds[:-1]
        before[edges[edges < len(data)]] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        edges = bounds[1:]
        after[edges[edges > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(bounds, self.start, side="right") - 1
        self.first = np.searchsorted(self.row, np.arange(len(texts) + 1))
        self.hash = run_hashes(self.bytes, self.start, self.end)

    def grams(self, k: int) -> np.ndarray:
        """A hash of the k words from each word on; meaningless where they leave the row."""
        n = max(len(self.hash) - k + 1, 0)
        total = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            total = total * _STEP + self.hash[j: j + n]
        return mixed(total)

    def spans(self, k: int) -> np.ndarray:
        """Where k words of one row start."""
        n = max(len(self.row) - k + 1, 0)
        return np.flatnonzero(self.row[:n] == self.row[k - 1: k - 1 + n])

    def text(self, i: int, k: int) -> bytes:
        return b" ".join(self.bytes[s:e].tobytes() for s, e in zip(self.start[i: i + k], self.end[i: i + k]))


def winnowed(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The start of every window, and the smallest gram hash inside it (the rightmost of equals has the same value)."""
    starts = words.spans(window)
    hashes = words.grams(gram)
    least = hashes[starts]
    for j in range(1, window - gram + 1):
        np.minimum(least, hashes[starts + j], out=least)
    return starts, least


def fingerprints(words: Words, k: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The start, the kept gram hash and the whole hash of every run of k words. A run shorter than a window is its own gram."""
    if k == window:
        starts, marks = winnowed(words, window, gram)
        return starts, marks, words.grams(k)[starts]
    starts = words.spans(k)
    marks = words.grams(k)[starts]
    return starts, marks, marks


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_WINDOWS = "mark long, k int, words string, print long, item_id string"
_SHARED = "array<struct<mark:bigint,k:int,words:string,at:array<bigint>>>"
_SHARED_ARROW = pa.list_(pa.struct([("mark", pa.int64()), ("k", pa.int32()), ("words", pa.string()), ("at", pa.list_(pa.int64()))]))


def _windows(window: int, gram: int):
    """Items to one row per window: its fingerprint, its words and its item."""

    def run(batches):
        for batch in batches:
            for start, length in slices(batch.column(1)):
                part = batch.slice(start, length)
                words = Words(part.column(1))
                counts = np.diff(words.first)
                for k in sorted({min(int(c), window) for c in np.unique(counts) if c}):
                    starts, marks, prints = fingerprints(words, k, window, gram)
                    own = counts[words.row[starts]]
                    at = np.flatnonzero(own >= window if k == window else own == k)
                    rows = words.row[starts[at]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(marks[at].view(np.int64)), pa.array(np.full(len(at), k, np.int32)),
                        pa.array([words.text(i, k).decode() for i in starts[at].tolist()], pa.string()),
                        pa.array(prints[at].view(np.int64)), part.column(0).take(pa.array(rows)),
                    ], names=["mark", "k", "words", "print", "item_id"])

    return run


def _places(mark, whole, bits: int) -> list:
    """Three bits of a sketch that a fingerprint and the hash of its window set (arrays of unsigned numbers)."""
    last = np.uint64(bits - 1)
    return [whole & last, (whole >> np.uint64(32)) & last, (mark >> np.uint64(17)) & last]


def _sketch(windows: DataFrame, most_bytes: int) -> np.ndarray:
    """A Bloom filter of all windows: 64 bits a window as far as ``most_bytes`` go. Made by one aggregate; the driver gets its words, no windows."""
    bits = 512
    n = windows.count()
    while bits < 64 * n and bits < 8 * most_bytes:
        bits *= 2
    places = F.array(*[F.expr(f"{e} & {bits - 1}L") for e in ("print", "shiftrightunsigned(print, 32)", "shiftrightunsigned(mark, 17)")])
    made = (
        windows.select(F.explode(places).alias("place"))
        .groupBy(F.expr("cast(shiftright(place, 6) as int)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63L as int)))").alias("value")).toArrow())
    sketch = np.zeros(bits // 64, dtype=np.uint64)
    sketch[made["word"].to_numpy()] = made["value"].to_numpy().view(np.uint64)
    return sketch


def _met(sketch_of, sizes: list[int], window: int, gram: int):
    """Documents to their number of words and those of their windows that the sketch lets through, each with its places."""

    def run(batches):
        let_go()
        sketch = sketch_of.value
        bits = 64 * len(sketch)
        for batch in batches:
            for start, length in slices(batch.column(2)):
                part = batch.slice(start, length)
                words = Words(part.column(2))
                shared: list[dict] = [{} for _ in range(len(part))]
                for k in sizes:
                    starts, marks, prints = fingerprints(words, k, window, gram)
                    ok = np.arange(len(starts))
                    for place in _places(marks, prints, bits):
                        place = place[ok]
                        ok = ok[(sketch[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
                    for i, mark in zip(starts[ok].tolist(), marks[ok].view(np.int64).tolist()):
                        row = int(words.row[i])
                        key = mark, k, words.text(i, k).decode()
                        shared[row].setdefault(key, []).append(i - int(words.first[row]))
                made = [[{"mark": m, "k": k, "words": w, "at": at} for (m, k, w), at in x.items()] for x in shared]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(words.first), pa.int64()), pa.array(made, _SHARED_ARROW)],
                    names=["row", "id", "n_words", "shared"])

    return run


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _merged(batches):
    """The windows found in a document to joined spans and sorted items."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans, items = [], []
        for found in batch.column(1).to_pylist():
            spans.append([{"start": s, "end": e} for s, e in _joined([(a, a + f["k"]) for f in found for a in f["at"]])])
            items.append(sorted({i for f in found for i in f["items"]}))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, spans_type), pa.array(items, pa.list_(pa.string()))], names=["id", "spans", "items"])


def _overlap(
    documents: DataFrame, benchmark: DataFrame, keep: list[str], text: str, item_id: str, item_text: str, window: int, gram: int,
    sketch_bytes: int, salts: int,
) -> tuple[DataFrame, DataFrame]:
    """The documents (``row``, ``id``, ``n_words``, ``shared``) as a stored table, and the windows of theirs that are an item's
    (``id``, ``k``, ``at``, ``items``)."""
    if not 1 <= gram <= window:
        raise ValueError("a gram must fit into a window")
    bounded_batches(documents.sparkSession)
    items = benchmark.select(
        col(item_id).cast("string").alias("item_id"), F.coalesce(col(item_text).cast("string"), F.lit("")).alias("text")).distinct()
    windows = materialised(items.mapInArrow(_windows(window, gram), _WINDOWS), "benchmark-windows")
    sizes = sorted(r.k for r in windows.select("k").distinct().collect())
    sketch = documents.sparkSession.sparkContext.broadcast(_sketch(windows, sketch_bytes))
    source = documents.select(
        F.struct(*[col(c).alias(c) for c in keep]).alias("row"), F.monotonically_increasing_id().alias("id"),
        col(text).cast("string").alias("text"))
    schema = T.StructType([
        source.schema["row"], T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("shared", T.DataType.fromDDL(_SHARED))])
    marked = materialised(source.mapInArrow(_met(sketch, sizes, window, gram), schema), "benchmark-marks")
    met = marked.select("id", F.explode("shared").alias("s")).select("id", "s.*")
    key = ["mark", "k", "words"]
    known = (
        windows.join(met.select(*key).distinct(), key).groupBy(*key).agg(F.collect_set("item_id").alias("items"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    salted = met.withColumn("salt", F.pmod("id", F.lit(salts)).cast("int"))
    return marked, salted.join(known, [*key, "salt"]).select("id", "k", "at", "items")


def benchmark_overlap(
    documents: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 10, gram: int = 5, sketch_bytes: int = SKETCH_BYTES, salts: int = SALTS,
) -> DataFrame:
    """For every document row: the kept columns as ``row``, ``n_words``, the word spans that occur in
    benchmark windows (``spans``: start and end, joined), and the sorted ids of the items with occurring windows (``items``).

    A null or empty text has no words and no hits; an item without words is no item; repeated items and rows count as they
    stand. With a null item id the item marks its words but names nothing. An empty benchmark hits nothing, an empty table of
    documents gives an empty table. A very long text is worked on whole, alone in its slice.
    """
    marked, hits = _overlap(documents, benchmark, keep, text, item_id, item_text, window, gram, sketch_bytes, salts)
    found = hits.groupBy("id").agg(F.collect_list(F.struct("k", "at", "items")).alias("found"))
    merged = found.mapInArrow(_merged, T.StructType([
        T.StructField("id", T.LongType()), T.StructField("spans", _SPAN), T.StructField("items", T.ArrayType(T.StringType()))]))
    none = [F.array().cast(_SPAN).alias("spans"), F.array().cast("array<string>").alias("items")]
    met = marked.filter(F.size("shared") > 0).join(merged, "id", "left").select(
        "row", "n_words", F.coalesce("spans", none[0]).alias("spans"), F.coalesce("items", none[1]).alias("items"))
    return marked.filter(F.size("shared") == 0).select("row", "n_words", *none).unionAll(met)


def digest(found: DataFrame) -> DataFrame:
    """The counts and the item digest of ``benchmark_overlap`` rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "row.*", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 10, gram: int = 5, sketch_bytes: int = SKETCH_BYTES, salts: int = SALTS,
) -> DataFrame:
    """The document rows without a benchmark window, all columns as they were; cases as in ``benchmark_overlap``. Only rows that pass
    the filter move, to be held against the hits."""
    marked, hits = _overlap(documents, benchmark, documents.columns, text, item_id, item_text, window, gram, sketch_bytes, salts)
    met = marked.filter(F.size("shared") > 0).join(hits.select("id").distinct(), "id", "left_anti")
    return marked.filter(F.size("shared") == 0).select("row.*").unionAll(met.select("row.*"))
