"""Rule measures against plain counting, the label model against known truth, and how labelled documents fare."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from patchloom.llm import quality_classifier, quality_rules
from patchloom.llm.label_model import fitted
from patchloom.llm.queries import op8_quality_rules, op9_quality_classifier


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i: i + 8]) for i in range(len(w) - 7)]
    covered = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures():
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(["a", "b ", "é ", " ", "\n", "#", " ", "\t", "|", "X! ", "a b a b a b a b ", "\x0b", "\x1c"]) for _ in range(rng.randrange(40)))
        assert quality_rules.measures(text)[:5] == plain(text), text
    assert quality_rules.measures(None)[:5] == (0, 0, 0, 0, 0)
    assert quality_rules.measures("same words " * 50_000)[4] == 100_000


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(40_000) < 0.8
    accuracy, votes = [0.95, 0.8, 0.65, 0.9], []
    for a in accuracy:
        v = np.where(rng.random(len(truth)) < a, truth, ~truth).astype(int)
        votes.append(np.where(rng.random(len(truth)) < 0.3, 2, v))
    patterns, counts = np.unique(np.stack(votes, axis=1), axis=0, return_counts=True)
    model = fitted(patterns, counts.astype(float), list("abcd"))
    assert abs(model.prior - 0.8) < 0.02
    assert all(abs(model.accuracy(r) - a) < 0.03 for r, a in zip("abcd", accuracy))


def test_label_model_without_rows():
    model = fitted(np.zeros((0, 2), np.int64), np.zeros(0), ["a", "b"])
    assert model.prior == 0.7 and np.isfinite(model.votes).all()


def test_kept_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = op8_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    good, bad = (rows.filter(F.col("quality") == q).agg(F.avg(F.col("kept").cast("int")), F.avg((F.col("base_failed") & F.col("kept")).cast("int")),
                 F.avg((F.col("kept") | F.col("base_failed")).cast("int"))).first() for q in (1, 0))
    assert good[2] > 0.99 and bad[0] < 0.1 and good[1] == bad[1] == 0


def test_rule_rows(spark):
    rows = [(1, "word " * 30, "x"), (2, None, "y"), (3, "", None), (None, "some words here", "z"), (2, None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out, _ = quality_rules.judged(df, ["doc_id", "kept"])
    got = {(r.row.doc_id, r.n_words, r.base_failed) for r in out.collect()}
    assert got == {(1, 30, True), (2, 0, True), (3, 0, True), (None, 3, True)} and out.count() == 5
    assert quality_rules.judged(df.limit(0), ["doc_id"])[0].count() == 0


def test_classifier_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = op9_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    good, bad = (rows.filter(F.col("quality") == q).agg(F.avg(F.col("good").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.97 and bad < 0.35


def test_the_sample_is_bounded_under_copies(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    _, model, _ = quality_classifier.classified(docs, ["text"])
    seen = quality_classifier._training(docs, "text", 400, 64, model)
    assert 250 < len(seen[1]) < 550 and seen[2].sum() >= len(seen[1])
    # every chosen text copied a hundred times: no more rows come, and the fit is that of all copies
    chosen = docs.filter(F.shiftrightunsigned(F.xxhash64("text"), 12) / float(1 << 52) < 400 / 1000.0)
    copied = docs.unionAll(chosen.select(F.explode(F.array_repeat("text", 99)).alias("text")))
    many = quality_classifier._training(copied, "text", 400 * copied.count() // 1000, 64, model)
    assert len(many[1]) == len(seen[1]) and (many[2] == 100 * seen[2]).all() and (many[0] == seen[0]).all()
    one, other = quality_classifier.fit_scorer(*seen), quality_classifier.fit_scorer(*many)
    assert np.allclose(one.weights, other.weights) and np.isclose(one.bias, other.bias)
    literal = quality_classifier.fit_scorer(*(np.repeat(x, seen[2].astype(int), axis=0) for x in seen[:2]), np.ones(int(seen[2].sum())))
    assert np.allclose(one.weights, literal.weights) and np.isclose(one.bias, literal.bias)


def test_classifier_equals_a_plain_scorer(spark):
    """Scores of whole texts, row by row."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows, _, scorer = quality_classifier.classified(docs, ["doc_id", "text"])
    import pyarrow as pa

    for r in rows.limit(40).collect():
        grams = quality_classifier.shape_grams(pa.array([r.row.text]), len(scorer.weights))[0].tolist()
        plain = 1 / (1 + np.exp(-(scorer.bias + sum(scorer.weights[g] for g in grams) / len(grams)))) if grams else 0.0
        assert np.isclose(r.score, plain) and r.good == (r.score >= 0.5)


def test_classifier_rows(spark):
    rows = [(1, "plain words in a row " * 5, "a"), (2, None, "b"), (3, "", "c"), (4, "ab", "d"), (1, "plain words in a row " * 5, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out, _, _ = quality_classifier.classified(df, ["doc_id", "score"])
    scores = [(r.row.doc_id, r.score) for r in out.collect()]
    assert scores[0] == scores[4] and [s for _, s in scores[1:4]] == [0.0, 0.0, 0.0]
    assert quality_classifier.classified(df.limit(0), ["doc_id"])[0].count() == 0


def test_shape_grams():
    import pyarrow as pa

    texts = pa.array(["Abc 12!", None, "", "abcdef", "x"])
    grams, bounds = quality_classifier.shape_grams(texts)
    alone = [quality_classifier.shape_grams(pa.array([t], pa.string()))[0].tolist() for t in texts.to_pylist()]
    assert [grams[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == alone
    assert len(alone[0]) == 4 and alone[3] == []  # Aaa 00! and aa
