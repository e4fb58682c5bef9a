"""A quality classifier without hand-made labels.

Overlapping heuristic labellers vote on every text; expectation-maximisation over the vote patterns
of all rows estimates their accuracies (``label_model``), which turns votes into posterior labels.
These train a hashed linear scorer, which also judges texts on which all labellers abstain, and looks
at more than they do: n-grams of character shapes (letters, capitals, digits, signs, white space),
hashed into a fixed number of buckets, one weight each.

Labelling and scoring are passes over the rows. The pattern counts are the only shuffle. The scorer is
fitted on a bounded sample of ``sample`` rows, chosen by a hash; everything else covers all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.hashing import mixed
from patchloom.llm.label_model import LabelModel, fitted, pattern_counts
from patchloom.llm.quality_rules import MEASURES, measures, rules, vote
from patchloom.llm.rows import col, utf8, with_text_columns
from patchloom.session import materialised

#: Buckets of the scorer, shapes in an n-gram, and rows it is fitted on (about).
BUCKETS, GRAM, SAMPLE = 1 << 10, 4, 4000

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = ord("0")
_SHAPE[65:91] = ord("A")
_SHAPE[97:123] = _SHAPE[128:] = ord("a")


def labellers() -> dict[str, F.Column]:
    """The quality rules, and second looks at the same faults: their votes overlap."""
    return rules() | {
        "symbol_share": vote(bad=F.col("n_symbols") * 20 > F.col("word_chars")),
        "much_repeated": vote(bad=F.col("n_repeat_words") * 2 > F.col("n_words")),
        "shouting": vote(bad=(F.col("n_capitals") + F.col("n_exclaimed")) * 2 > F.col("n_words")),
    }


def shape_grams(texts: pa.Array, buckets: int = BUCKETS, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each shape n-gram of the texts, and where each text's begin (with a last end). Runs of one shape of
    letters count up to twice, so that word length weighs little."""
    data, bounds = utf8(texts)
    shapes = _SHAPE[data]
    keep = np.ones(len(shapes), dtype=bool)
    keep[2:] = (shapes[2:] != shapes[1:-1]) | (shapes[2:] != shapes[:-2])
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))[keep]
    shapes = shapes[keep].astype(np.uint64)
    n = max(len(shapes) - gram + 1, 0)
    code = np.zeros(n, dtype=np.uint64)
    for j in range(gram):
        code = code << np.uint64(8) | shapes[j: j + n]
    inside = row[:n] == row[gram - 1: gram - 1 + n]
    grams = (mixed(code[inside]) & np.uint64(buckets - 1)).astype(np.int64)
    return grams, np.searchsorted(row[:n][inside], np.arange(len(texts) + 1))


@dataclass(frozen=True)
class LinearScorer:
    """Logistic score: ``bias`` plus the mean weight of a text's n-grams."""

    weights: np.ndarray
    bias: float
    gram: int = GRAM

    def scores(self, texts: pa.Array) -> np.ndarray:
        """0 for a text without an n-gram."""
        grams, bounds = shape_grams(texts, len(self.weights), self.gram)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[grams])])
        n = np.diff(bounds)
        mean = np.diff(sums[bounds]) / np.maximum(n, 1)
        return np.where(n > 0, 1 / (1 + np.exp(-np.clip(self.bias + mean, -500, 500))), 0.0)


def fit_scorer(shares: np.ndarray, labels: np.ndarray, copies: np.ndarray, rounds: int = 12, penalty: float = 1e-2) -> LinearScorer:
    """Ridge logistic regression of soft labels on n-gram shares (a row per text, which stands for ``copies``), by Newton steps on scaled
    shares. Rows of the rarer side weigh more, so that both sides count alike. Without rows every score is even."""
    if not len(labels):
        return LinearScorer(np.zeros(shares.shape[1]), 0.0)
    part = copies / copies.sum()
    middle = part @ shares
    scale = 1 / np.maximum(np.sqrt(part @ (shares - middle) ** 2), 1e-3)
    x = np.concatenate([(shares - middle) * scale, np.ones((len(shares), 1))], axis=1)
    good = np.clip(part @ labels, 0.02, 0.98)
    weight = (labels / good + (1 - labels) / (1 - good)) * part
    weight /= weight.sum()
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6  # the bias is free
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        curve = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (p - labels)) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    w, bias = w[:-1] * scale, w[-1]
    return LinearScorer(w, float(bias - middle @ w))


def _measured(df: DataFrame, keep: list[str], text: str, scorer: LinearScorer | None = None) -> DataFrame:
    def work(texts: pa.Array) -> list:
        made = [pa.array(x, pa.int64()) for x in zip(*map(measures, texts.to_pylist()))]
        return made if scorer is None else [*made, pa.array(scorer.scores(texts))]

    fields = [T.StructField(m, T.LongType()) for m in MEASURES]
    if scorer is not None:
        fields.append(T.StructField("score", T.DoubleType()))
    return with_text_columns(df, text, keep, fields, lambda: work)


def _training(df: DataFrame, text: str, sample: int, buckets: int, model: LabelModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares, posteriors and numbers of copies of about ``sample`` texts at most, drawn by a hash of the text. Copies fall together before they are
    collected, and a text that has many comes with their number."""
    total = df.count()
    texts_ = df.select(col(text).cast("string").alias("text")).select("text", F.xxhash64("text").alias("h"), F.xxhash64(F.reverse("text")).alias("g"))
    chosen = texts_.filter(F.shiftrightunsigned("h", 12) / float(1 << 52) < float(sample) / max(total, 1))

    def work(texts: pa.Array) -> list:
        grams, bounds = shape_grams(texts, buckets)
        parts = [np.unique(grams[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]
        return [[p[0] for p in parts], [p[1] for p in parts], *zip(*map(measures, texts.to_pylist()))]

    fields = [T.StructField("bucket", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.LongType())),
              *[T.StructField(m, T.LongType()) for m in MEASURES]]
    made = with_text_columns(chosen, "text", ["h", "g"], fields, lambda: work).filter(F.size("bucket") > 0)
    made = made.select("row.*", "bucket", "n", model.posterior(list(labellers().values())).alias("p"))
    rows = made.groupBy("h", "g").agg(*[F.first(c).alias(c) for c in ("bucket", "n", "p")], F.count("*").alias("copies")).collect()
    rows.sort(key=lambda r: (r["p"], r["h"], r["g"]))
    shares = np.zeros((len(rows), buckets), dtype=np.float32)
    for i, r in enumerate(rows):
        shares[i, r["bucket"]] = np.array(r["n"], dtype=np.float32) / sum(r["n"])
    return shares, np.array([r["p"] for r in rows]), np.array([r["copies"] for r in rows], dtype=float)


def classified(df: DataFrame, keep: list[str], text: str = "text", sample: int = SAMPLE, buckets: int = BUCKETS,
               least: float = 0.5) -> tuple[DataFrame, LabelModel, LinearScorer]:
    """Every row's kept columns as ``row``, ``p_weak`` (what the labellers alone say), ``score`` (the scorer, 0 to 1) and ``good``
    (score of at least ``least``); the label model; the scorer.

    Null texts and texts shorter than one n-gram have score 0. Repeated rows give repeated results. An empty table gives
    none, and models at their starting points.
    """
    votes = labellers()
    seen = materialised(_measured(df, keep, text), "measures")
    model = fitted(*pattern_counts(seen.select(*[v.alias(r) for r, v in votes.items()]), list(votes)), list(votes))
    scorer = fit_scorer(*_training(df, text, sample, buckets, model))
    rows = _measured(df, keep, text, scorer).select(
        "row", model.posterior(list(votes.values())).alias("p_weak"), "score", (F.col("score") >= least).alias("good"))
    return rows, model, scorer
