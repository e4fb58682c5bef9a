"""Importance resampling against plain counting, with odd rows, very long texts and colliding hashes."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from patchloom.llm import importance, interning
from patchloom.llm.decontamination import Words
from patchloom.llm.interning import Grams

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORD.findall((text or "").translate(FOLD))
    return len(words), Counter(zlib.crc32(" ".join(words[i: i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1))


def plain(documents, target):
    """doc_id, n_features, weight, score, rank of every row, row by row."""
    s, t = Counter(), Counter()
    for _, text in documents:
        s += features(text)[1]
    for text in target:
        t += features(text)[1]
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000.0) / ((s[b] + 1.0) * (t_all + 10000.0))))
    rows = []
    for i, text in documents:
        n, own = features(text)
        weight = sum(gain(b) * c for b, c in own.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, sum(own.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: 5 * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def found(spark, documents, target, schema="doc_id long, text string"):
    df = importance.resampled(spark.createDataFrame(documents, schema), spark.createDataFrame([(t,) for t in target], "text string"))
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_equals_plain_counting(spark):
    rng = np.random.default_rng(7)
    names = [*"abcdefghij", "the", "Überall", "x" * 40, "日本語", "42", "word" * 9]
    documents = [(i, " ".join(rng.choice(names, rng.integers(0, 90)))) for i in range(150)]
    documents += [(150, None), (151, ""), (152, "--- !!"), (None, "a b c " * 9), (7, documents[7][1]), (7, documents[7][1]), (153, "A, B\tc d " * 3000)]
    target = ["the a b Überall 42 " * 30, None, "", "日本語 j j j"]
    assert found(spark, documents, target) == plain(documents, target)


def test_empty_tables_and_other_columns(spark):
    documents = [(i, f"word{i} and more " * 10, None, 1.0) for i in range(45)]
    schema = "doc_id long, text string, `row` string, weight double"
    out = found(spark, documents, [], schema)
    assert out == plain([r[:2] for r in documents], []) and sum(r[4] is not None for r in out) == 2
    assert found(spark, [], ["a b"]) == []
    assert found(spark, [(1, None), (2, "")], [None]) == plain([(1, None), (2, "")], [None])


@pytest.mark.parametrize("limit", [7, 30, 1000])
def test_long_text_in_parts(limit):
    text = "The cat, sat on the mat. " * 12 + "y" * 60 + " Ende über  alles " * 3
    whole = Grams(Words(pa.array([text])), 3, 10000)
    want = np.bincount(whole.bucket, weights=whole.count, minlength=10000)
    got, n_words = np.zeros(10000), 0
    for words, sign in importance.parts(pa.array([text]), 3, limit):
        grams = Grams(words, 3, 10000)
        got += sign * np.bincount(grams.bucket, weights=grams.count, minlength=10000)
        n_words += sign * len(words.start)
    assert (got == want).all() and n_words == len(WORD.findall(text))


def test_collisions_are_verified():
    """With one hash for all, every word and gram still has a slot of its own."""
    values = np.array([3, 1, 3, 2, 1, 9])
    slot, owner = interning.interned(np.zeros(6, np.uint64), lambda i, j: values[i] == values[j])
    assert len(set(slot.tolist())) == 4 and (values[owner[slot]] == values).all()


def test_hashes_and_checksums():
    import xxhash

    rng = np.random.default_rng(1)
    for size in range(1, 32):
        rows = rng.integers(0, 256, (4, size), dtype=np.uint8)
        assert interning.xxh64(rows, 42).tolist() == [xxhash.xxh64_intdigest(r.tobytes(), 42) for r in rows]
    crc = np.array([zlib.crc32(b"left")], np.uint32)
    for n in (0, 1, 63, 64, 65, 200):
        right = bytes(rng.integers(0, 256, n, dtype=np.uint8))
        assert int(interning.shifted(crc, np.array([n]))[0]) ^ zlib.crc32(right) == zlib.crc32(b"left" + right)
