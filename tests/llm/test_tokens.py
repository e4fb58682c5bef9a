"""Token counts against a tokenizer library, segmentations against it and against all segmentations of short texts."""

import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from patchloom.llm import segmentation, token_counts
from patchloom.llm.lattice import Automaton, Hashed, Lattice
from patchloom.llm.vocabulary import SPACE, Vocabulary, load_vocabulary

SIGNS = ["a", "b", "e", " ", "  ", "é", "\n", "<s>", "th", "er", "▁", "😀", "字", "ḁ", ".", "1", "\t", "ing", "<0x41>", "x" * 70]


@pytest.fixture(scope="module")
def pieces():
    return load_vocabulary()


def library(v, byte_fallback):
    t = Tokenizer(models.Unigram(list(zip(v.pieces, v.scores)), unk_id=v.unknown, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=SPACE, prepend_scheme="always", split=True)
    return t


def texts_of(sf_dir, spark):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_equal_the_library(pieces, fallback):
    v = pieces if fallback else Vocabulary(pieces.pieces, pieces.scores, (), pieces.plain, pieces.unknown)
    rng = random.Random(4)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(14))) for _ in range(6000)]
    t = library(v, fallback)
    assert token_counts.TokenCounter(v).counts(texts).tolist() == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ties_follow_the_library():
    rng = random.Random(9)
    for _ in range(150):
        bits = sorted({"".join(rng.choice("ab" + SPACE) for _ in range(rng.randrange(1, 4))) for _ in range(9)} | {"<unk>"})
        v = Vocabulary(tuple(bits), tuple(float(-rng.randrange(3)) for _ in bits), (), tuple(range(len(bits))), bits.index("<unk>"))
        texts = ["".join(rng.choice("abc ") for _ in range(rng.randrange(10))) for _ in range(40)]
        t = library(v, False)
        assert token_counts.TokenCounter(v).counts(texts).tolist() == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_both_finders_find_the_same(pieces):
    rng = random.Random(2)
    words = [SPACE + "".join(rng.choice(["th", "e", "ing", "é", "字", "q"]) for _ in range(rng.randrange(9))) for _ in range(300)]
    plain = tuple((pieces.pieces[i], i) for i in pieces.plain)
    edges = [sorted(zip(x.start.tolist(), x.end.tolist(), x.piece.tolist())) for x in (Lattice(words, f(plain)) for f in (Automaton, Hashed))]
    assert edges[0] == edges[1]


def test_count_rows(spark, sf_dir, pieces):
    rows = [(1, "the thing", 5), (2, None, None), (3, "", 1), (1, "the thing", 5), (4, "x" * 50_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = sorted(tuple(r) for r in token_counts.token_counts(df, ["doc_id"]).select("row.*", "n_tokens").collect())
    size = lambda s: len(library(pieces, True).encode(s, add_special_tokens=False).ids)
    assert out == [(1, size("the thing"))] * 2 + [(2, 0), (3, 0), (4, size("x" * 50_000))]
    texts = texts_of(sf_dir, spark)
    assert token_counts.TokenCounter(pieces).counts(texts).tolist() == [
        len(e.ids) for e in library(pieces, True).encode_batch(texts, add_special_tokens=False)]


def every(segmenter, word):
    """Scores and ids of all segmentations, by the edges of the word."""
    into, ways = segmenter.edges(word), {0: [(0.0, ())]}
    for end in range(1, len(word) + 1):
        ways[end] = [(s + q, ids + segmenter._ids(word, [(start, end, i)])) for start, i, q in into[end] for s, ids in ways[start]]
    return ways[len(word)]


def test_n_best_of_words_and_texts(pieces):
    segmenter = segmentation.Segmenter(pieces)
    rng = random.Random(6)
    for _ in range(400):
        word = SPACE + "".join(rng.choice(["a", "e", "th", "er", "字", "in", "on"]) for _ in range(rng.randrange(5)))
        found = segmenter.n_best(word, 6)
        assert [s for s, _ in found] == sorted((s for s, _ in every(segmenter, word)), reverse=True)[:6]
        assert set(found) <= set(every(segmenter, word)) and len(set(found)) == len(found)
        text = "".join(rng.choice(["a", " ", "th", "er", "é", "in", "\n"]) for _ in range(rng.randrange(1, 7)))
        e = segmenter.encode([text], 5)
        whole = sorted((s for s, _ in every(segmenter, SPACE + text.replace(" ", SPACE))), reverse=True)[:5]
        assert [e.scores[0], *[a["score"] for a in e.alternatives[0]]] == whole


def test_alternatives_rebuild(pieces):
    segmenter = segmentation.Segmenter(pieces)
    text = "the thing here  there\nand on"
    e = segmenter.encode([text], 6)
    cut = segmentation.CutTexts([text], always=True, runs=True)
    words = [cut.words[i] for i in cut.at]
    for way in e.alternatives[0]:
        parts = [segmenter.n_best(w, 1)[0][1] for w in words]
        for change in way["changes"]:
            parts[change["word"]] = tuple(change["ids"])
        ids = [i for p in parts for i in p]
        assert segmenter.decode(ids) == text and len(ids) == way["n_pieces"]


def test_best_equals_the_library_and_decodes(spark, sf_dir, pieces):
    segmenter = segmentation.Segmenter(pieces)
    texts = texts_of(sf_dir, spark)
    e = segmenter.encode(texts)
    ids = [e.ids[a:b].tolist() for a, b in zip(e.bounds[:-1], e.bounds[1:])]
    assert ids == [x.ids for x in library(pieces, True).encode_batch(texts, add_special_tokens=False)]
    assert [segmenter.decode(i) for i in ids] == texts and e.spelled.all()
    rng = random.Random(8)
    for _ in range(2000):
        t = "".join(rng.choice([s for s in SIGNS if s != SPACE]) for _ in range(rng.randrange(9)))
        assert segmenter.decode(segmenter.encode([t]).ids.tolist()) == t


def test_segmentation_rows(spark):
    rows = [(1, "the thing", "a"), (2, None, "b"), (3, "", "c"), (1, "the thing", "a"), (4, "a▁b", None), (5, "y" * 20_000, None), (6, " ", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    table = segmentation.encoded(df, ["doc_id", "text"])
    out = table.select("row.*", "ids", "exact", "alternatives").collect()
    assert [r.exact for r in out] == [True, True, True, True, False, True, True]
    assert out[1].ids is None and out[2].ids == [] and out[0] == out[3] and out[1].alternatives == []
    back = segmentation.decoded(table.select("row.doc_id", F_col(table, "text"), "ids"), ["doc_id", "text"]).collect()
    assert all(r.text == r.row.text or r.row.doc_id == 4 for r in back)
    assert segmentation.encoded(df.limit(0), ["doc_id"]).count() == 0


def F_col(table, name):
    from pyspark.sql import functions as F

    return F.col(f"row.{name}").alias(name)


def colliding(a, b):
    """Two words of 1,024 characters with one hash modulo 2 ** 64, whatever the base: the Thue-Morse word and its complement."""
    signs = [bin(i).count("1") & 1 for i in range(1024)]
    return "".join((a, b)[x] for x in signs), "".join((b, a)[x] for x in signs)


def test_words_with_one_hash_stay_apart(pieces):
    import numpy as np

    from patchloom.llm.hashing import run_hashes
    from patchloom.llm.lattice import code_points

    one, other = colliding("t", "h")
    points = code_points(one + other)
    hashes = run_hashes(points, np.array([0, 1024]), np.array([1024, 2048]))
    assert hashes[0] == hashes[1]
    counter, segmenter = token_counts.TokenCounter(pieces), segmentation.Segmenter(pieces)
    alone = [token_counts.TokenCounter(pieces).counts([t])[0] for t in (one, other)]
    assert alone[0] != alone[1]
    for texts in ([one, other], [f"{one} {other}", other], [other], [one, "the", one]):
        assert counter.counts(texts).tolist() == [token_counts.TokenCounter(pieces).counts([t])[0] for t in texts]
        e = segmenter.encode(texts)
        ids = [e.ids[a:b].tolist() for a, b in zip(e.bounds[:-1], e.bounds[1:])]
        assert [segmenter.decode(i) for i in ids] == texts and e.spelled.all()
        assert ids == [x.ids for x in library(pieces, True).encode_batch(texts, add_special_tokens=False)]


def test_memory_is_bounded_in_bytes(pieces):
    counter = token_counts.TokenCounter(pieces)
    counter.known.room = 40_000
    segmenter = segmentation.Segmenter(pieces)
    segmenter.known.room = 40_000
    for k in range(6):
        texts = [" ".join(f"word{k}x{i}" for i in range(300)), "q" * 30_000, f"w{k}"]
        assert counter.counts(texts).tolist() == token_counts.TokenCounter(pieces).counts(texts).tolist()
        assert segmenter.encode(texts).ids.tolist() == segmentation.Segmenter(pieces).encode(texts).ids.tolist()
        assert counter.known.held <= 20_000 and segmenter.known.held <= 20_000
        assert all(len(known.young) + len(known.old) < 400 for known in (counter.known, segmenter.known))


def test_a_worker_lets_go():
    from patchloom.llm import words

    first = words.kept("a", lambda: [1])
    assert words.kept("a", lambda: [2]) is first
    words.let_go()
    assert words.kept("a", lambda: [2]) == [2]
    words.let_go()
