"""The forward sum against all segmentations, learning, and held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchloom.llm import language_id as li
from patchloom.llm.vocabulary import SPACE, load_vocabulary

WORDS = ["the", "thonre", "étréé", "字ḁx", "a", "ciónmenteie", "x" * 30, "ḁ" * 200]


@pytest.fixture(scope="module")
def pieces():
    return load_vocabulary()


def plain(word, logs, v):
    ids = {v.pieces[i]: i for i in v.plain}
    w = SPACE + word
    total = [0.0] + [-np.inf] * len(w)
    for e in range(1, len(w) + 1):
        for s in range(max(0, e - 40), e):
            if w[s:e] in ids:
                total[e] = np.logaddexp(total[e], total[s] + logs[ids[w[s:e]]])
        if w[e - 1] not in ids:
            total[e] = np.logaddexp(total[e], total[e - 1] + sum(logs[v.bytes[b]] for b in w[e - 1].encode()))
    return total[-1]


def test_words_are_summed_over_all_segmentations(pieces):
    logs = np.log(np.random.default_rng(0).dirichlet(np.ones(len(pieces.pieces)), size=3))
    lattice = li.LanguageLattice(WORDS, pieces)
    expected = np.array([[plain(w, x, pieces) for x in logs] for w in WORDS])
    for k, x in enumerate(logs):
        weight = lattice.weights(x)
        assert np.allclose(lattice.forward(weight)[lattice.last], expected[:, k])
        assert np.allclose(lattice.backward(weight)[lattice.begin], expected[:, k])
    lengths = np.array([len(p) for p in pieces.pieces])
    assert np.allclose(lattice.chances(logs.T.copy(), np.exp(logs.T + li._LIFT * lengths[:, None])), expected)


def test_remembered_scores_are_the_same(pieces, monkeypatch):
    import pyarrow as pa

    logs = np.log(np.random.default_rng(1).dirichlet(np.ones(len(pieces.pieces)), size=2))
    texts = pa.array(["the thing", "étréé the", None, "42 !", "the thing thonre", "other words and more"] * 3)
    once = li._scored(li.LanguageModel(("a", "b"), logs, pieces))(texts)
    few = li._Scores(li.LanguageModel(("a", "b"), logs, pieces), room=900)
    monkeypatch.setattr(li, "kept", lambda name, make: few)
    many = li._scored(li.LanguageModel(("a", "b"), logs, pieces))
    parts = [many(texts.slice(i, 2)) for i in range(0, len(texts), 2)]
    assert sum((p[0] for p in parts), []) == once[0] and np.allclose(sum((p[1] for p in parts), []), once[1])
    assert once[0][2:4] == ["und", "und"] and once[1][2:4] == [0.0, 0.0]
    assert few.known.held <= 450 and len(few.known.young) + len(few.known.old) <= 4


def test_words_with_one_hash_stay_apart(pieces):
    import pyarrow as pa

    signs = [bin(i).count("1") & 1 for i in range(1024)]
    one, other = ("".join(x[i] for i in signs) for x in ("th", "ht"))
    logs = np.log(np.random.default_rng(3).dirichlet(np.ones(len(pieces.pieces)), size=2))
    model = lambda: li._scored(li.LanguageModel(("a", "b"), logs, pieces))
    alone = [model()(pa.array([t])) for t in (one, other)]
    both = model()(pa.array([one, other]))
    assert both[1] == [alone[0][1][0], alone[1][1][0]] and both[0] == [alone[0][0][0], alone[1][0][0]]


def test_commonest_of_many_languages(spark):
    rows = [(i, "the thing and more", f"l{i % 7}" if i < 70 else "noise") for i in range(72)] + [(100, "der und von", "l6")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    some = li.training_rows(df, most_languages=3)
    assert {r.language for r in some.select("language").distinct().collect()} == {"l0", "l1", "l6"}
    assert li.learned(li.training_rows(df), rounds=1, most_languages=2).languages == ("l0", "l6")


def test_learning_raises_the_likelihood(spark, pieces):
    rows = spark.createDataFrame([("en", "the other thing and the rest of the things"), ("xx", "zu und von der einung")], "language string, text string")
    values = []
    for rounds in (0, 1, 4):
        model = li.learned(rows, rounds=rounds)
        assert model.languages == ("en", "xx")
        values.append(sum(plain(w, model.logs[0], pieces) for w in "the other thing and the rest of the things".split()))
    assert values[0] < values[1] < values[2]


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.learned(li.training_rows(df.filter(~li.held_out())))
    found = li.identified(df.withColumn("out", li.held_out()), model, ["lang", "out"]).filter("row.out and language <> 'und'")
    right, total = found.agg(F.avg((F.col("row.lang") == F.col("language")).cast("double")), F.count("*")).first()
    assert total > 150 and right > 0.97


def test_rows(spark):
    rows = [(1, "the thing", "en", "q"), (2, "der und von", "de", None), (3, None, "en", None), (4, "", "de", None), (5, "1 2 ²", None, None),
            (None, "the thing", None, "x"), (1, "the thing", "en", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = li.learned(li.training_rows(df))
    out = [(r.row.doc_id, r.language) for r in li.identified(df, model, ["doc_id", "score"]).collect()]
    assert out == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (1, "en")]
    assert li.training_rows(df, most_documents=0).count() == 0
    nothing = li.learned(li.training_rows(df.limit(0)))
    assert nothing.languages == ()
    assert {r.language for r in li.identified(df, nothing, ["doc_id"]).collect()} == {"und"}
    held = [tuple(r) for r in spark.createDataFrame([(6,), (None,), (7,)], "doc_id long").select(li.held_out()).collect()]
    import zlib

    assert held == [(zlib.crc32(b"6") % 5 == 0,), (True,), (zlib.crc32(b"7") % 5 == 0,)]
