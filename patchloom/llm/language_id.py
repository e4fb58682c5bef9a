"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a
word is the sum over all its segmentations into pieces of the product of their probabilities, which
a forward pass adds up; a text's score is the sum of its words' logarithms. No single segmentation
is chosen, so a language is not judged by how a tokenizer made for another one would cut its words.

Learning: piece probabilities come from expectation-maximisation (forward-backward expected piece
counts) over the word counts of labelled documents, a bounded sample of ``most_documents`` per
language. Words are counted by Spark with combining before the shuffle; each round is one pass over
the distinct words of the sample and one small aggregation by (language, piece).

Scoring is one pass over the rows, whole texts, no shuffle.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.lattice import Lattice, code_points, hashed
from patchloom.llm.rows import col, with_text_columns
from patchloom.llm.vocabulary import DEFAULT_VOCABULARY, SPACE, Vocabulary, load_vocabulary, plain_pieces
from patchloom.llm.words import CACHE_BYTES, Remembered, kept, told_apart
from patchloom.session import materialised

UNDETERMINED = "und"
#: Labelled documents per language that the model learns from, about.
MOST_DOCUMENTS = 1500
#: The languages a model learns: of more labels the commonest ones, of equally common ones the first by name.
MOST_LANGUAGES = 500
#: Words scored in one go (fewer where languages are many), and bytes of their scores at every character.
AT_ONCE, AT_ONCE_BYTES = 4_000, 32 << 20
#: Text bytes cut into words in one go.
TEXT_BYTES = 1 << 20
_LIFT = 2.5
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower case."""
    return _LETTERS.findall(text.lower())


def _letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


class LanguageLattice(Lattice):
    """Words led by the space mark; a character without a piece costs its byte pieces."""

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        super().__init__([SPACE + w for w in words], hashed(plain_pieces(vocabulary)))
        self.bytes = [[vocabulary.bytes[b] for b in x] if vocabulary.bytes else [] for x in self.bare_bytes()]

    def weights(self, logs: np.ndarray) -> np.ndarray:
        """Log weight of every edge under piece log probabilities."""
        w = logs[self.piece]
        for e, b in zip(self.bare.tolist(), self.bytes):
            w[e] = logs[b].sum() if b else logs.min() - 10
        return w

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Log sum over the paths from the word's beginning to each node."""
        total = np.full(self.nodes, -np.inf)
        total[self.begin] = 0.0
        for lo, hi in zip(self.steps[:-1], self.steps[1:]):
            np.logaddexp.at(total, self.target[lo:hi], total[self.source[lo:hi]] + weight[lo:hi])
        return total

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """Log sum over the paths from each node to the word's end. Edges are taken from the last step back: all edges that
        leave a node end in a later step than those that reach it."""
        rest = self.first[self.word + 1] - self.start
        order = np.argsort(rest, kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.bincount(rest, minlength=1)[1:])])
        total = np.full(self.nodes, -np.inf)
        total[self.last] = 0.0
        for lo, hi in zip(steps[:-1].tolist(), steps[1:].tolist()):
            at = order[lo:hi]
            np.logaddexp.at(total, self.source[at], total[self.target[at]] + weight[at])
        return total

    def chances(self, table: np.ndarray, lifted: np.ndarray) -> np.ndarray:
        """Log probability of every word under every column of ``table`` (log piece probabilities, a row for each piece).

        Sums are kept as plain numbers, each character lifted by ``_LIFT`` (``lifted`` holds the lifted probabilities); the few
        words whose numbers still grow too small or too large (long runs of rare characters) are worked out with logarithms.
        """
        weight = lifted[self.piece]
        for e, b in zip(self.bare.tolist(), self.bytes):
            weight[e] = np.exp((table[b].sum(axis=0) if b else table.min(axis=0) - 10) + _LIFT)
        total = np.zeros((self.nodes, table.shape[1]))
        total[self.begin] = 1.0
        for lo, hi, group in self.groups():
            total[self.target[group]] = np.add.reduceat(total[self.source[lo:hi]] * weight[lo:hi], group - lo, axis=0)
        ends = total[self.last]
        with np.errstate(divide="ignore"):
            out = np.log(ends) - (_LIFT * np.diff(self.first))[:, None]
        odd = ~((ends > 1e-250) & (ends < 1e250)).all(axis=1)
        if odd.any():
            for k in range(table.shape[1]):
                out[odd, k] = self.forward(self.weights(table[:, k]))[self.last][odd]
        return out


@dataclass(frozen=True)
class LanguageModel:
    """Log piece probabilities per language (a row each, in the order of ``languages``)."""

    languages: tuple[str, ...]
    logs: np.ndarray
    vocabulary: Vocabulary
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class _Scores:
    """Log probabilities of words under every language, remembered within ``room`` bytes."""

    def __init__(self, model: LanguageModel, room: int = CACHE_BYTES):
        self.vocabulary = model.vocabulary
        self.logs = np.ascontiguousarray(model.logs.T)
        lengths = np.fromiter(map(len, model.vocabulary.pieces), np.int64, len(model.vocabulary.pieces))
        self.lifted = np.exp(self.logs + (_LIFT * lengths)[:, None])
        self.at_once = max(min(AT_ONCE, AT_ONCE_BYTES // (64 * max(len(model.languages), 1))), 64)
        self.known = Remembered(self.learn, lambda row: 33 + len(row), room)

    def learn(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(words), self.at_once):
            rows = LanguageLattice(words[i: i + self.at_once], self.vocabulary).chances(self.logs, self.lifted)
            data, size = np.ascontiguousarray(rows, dtype=np.float64).tobytes(), 8 * rows.shape[1]
            out += [data[k: k + size] for k in range(0, len(data), size)]
        return out

    def of(self, words: list[str]) -> np.ndarray:
        """A row for each of some distinct words."""
        return np.frombuffer(b"".join(self.known.of(words)), dtype=np.float64).reshape(len(words), -1)


def _scored(model: LanguageModel):
    scores = kept(f"language {model.name}", lambda: _Scores(model))

    def work(texts: pa.Array) -> list:
        lowered = [t.lower() if t else "" for t in texts.to_pylist()]
        joined = "\n".join(lowered)
        points = code_points(joined)
        inside = np.zeros(len(points) + 2, dtype=bool)
        inside[1:-1] = _is_letter()[points]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
        row_ends = np.searchsorted(start, ends)
        names, values = [UNDETERMINED] * len(lowered), [0.0] * len(lowered)
        if len(start) and model.languages:
            first, at = told_apart(points, start, end)
            table = scores.of([joined[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())])
            lo = 0
            for row, hi in enumerate(row_ends.tolist()):
                if hi > lo:
                    total = table[at[lo:hi]].sum(axis=0)
                    best = int(total.argmax())
                    names[row], values[row] = model.languages[best], float(1 / np.exp(total - total[best]).sum())
                lo = hi
        return [names, values]

    return work


def identified(df: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """Every row's kept columns as ``row``, its ``language`` and ``score`` (the posterior of that language, all being equally
    likely before, 0 to 1). Null texts, texts without a letter, and all texts of a model without languages are ``und`` with
    score 0. Of equal languages the first by name wins. Repeated rows give repeated results, an empty table an empty one. A text is scored whole,
    however long."""
    return with_text_columns(
        df, text, keep, [T.StructField("language", T.StringType()), T.StructField("score", T.DoubleType())],
        lambda: _scored(model), TEXT_BYTES)


def training_rows(df: DataFrame, doc_id: str = "doc_id", text: str = "text", language: str = "lang",
                  most_documents: int = MOST_DOCUMENTS, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """``language`` and ``text`` of about ``most_documents`` rows per language, chosen by a hash of the row, so that the choice is
    the same every time. Rows without text or language are left out, as are those of all but the ``most_languages`` commonest languages
    (of equally common ones the first by name count)."""
    rows = df.select(col(language).cast("string").alias("language"), col(text).cast("string").alias("text"),
                     F.xxhash64(col(doc_id).cast("string"), F.length(col(text))).alias("h")).filter("language is not null and text is not null")
    # one number per language comes to the driver, so that texts are chosen in the scan and never move by their language
    sizes = rows.groupBy("language").count().orderBy(F.desc("count"), "language").limit(most_languages).collect()
    share = F.lit(0.0)
    for name, n in sorted(sizes):
        share = F.when(F.col("language") == name, most_documents / n).otherwise(share)
    return rows.filter((F.shiftrightunsigned("h", 12) / float(1 << 52)) < share).select("language", "text")


def _word_counts(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, words = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [w for w in map(_letters, words_of(text)) if w]
                languages += [name] * len(found)
                words += found
            yield pa.RecordBatch.from_arrays([pa.array(languages, pa.string()), pa.array(words, pa.string())], names=["language", "word"])

    return rows.mapInArrow(run, "language string, word string").groupBy("language", "word").agg(F.count("*").alias("n"))


def _expected(model: LanguageModel):
    """Expected piece counts of word counts under the current model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(model.logs.shape)
        for batch in batches:
            names = np.array([model.languages.index(x) for x in batch.column(0).to_pylist()], dtype=np.int64)
            words, counts = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for k in np.unique(names).tolist():
                at = np.flatnonzero(names == k)
                for i in range(0, len(at), AT_ONCE):
                    some = at[i: i + AT_ONCE]
                    lattice = LanguageLattice([words[j] for j in some.tolist()], model.vocabulary)
                    weight = lattice.weights(model.logs[k])
                    ahead, behind = lattice.forward(weight), lattice.backward(weight)
                    share = np.exp(ahead[lattice.source] + weight + behind[lattice.target] - ahead[lattice.last][lattice.word])
                    share *= counts[some][lattice.word]
                    plain = lattice.piece >= 0
                    totals[k] += np.bincount(lattice.piece[plain], share[plain], totals.shape[1])
                    for e, b in zip(lattice.bare.tolist(), lattice.bytes):
                        np.add.at(totals[k], b, share[e])
        k, piece = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(piece), pa.array(totals[k, piece])], names=["k", "piece", "n"])

    return run


def learned(rows: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, rounds: int = 3, smoothing: float = 0.1,
            most_languages: int = MOST_LANGUAGES) -> LanguageModel:
    """A model from rows of ``language`` and ``text``. Every piece keeps a little probability (``smoothing`` counts), so no
    text is impossible in any language. Of more than ``most_languages`` labels those with most words are learned. What comes to the driver is one number per language and piece. No rows: no languages."""
    pieces = load_vocabulary(vocabulary)
    if not pieces.words_part:
        raise ValueError("a piece runs over the end of a word")
    counts = materialised(_word_counts(rows), "words")
    languages = tuple(sorted(r[0] for r in counts.groupBy("language").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "language").limit(most_languages).collect()))
    counts = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(x,) for x in languages], "language string")), "language", "left_semi")
    used = np.zeros(len(pieces.pieces), dtype=bool)
    used[list(pieces.plain) + list(pieces.bytes)] = True
    logs = np.where(used, -np.log(used.sum()), -np.inf) + np.zeros((len(languages), 1))
    for _ in range(rounds):
        model = LanguageModel(languages, logs, pieces)
        found = counts.mapInArrow(_expected(model), "k long, piece long, n double").groupBy("k", "piece").agg(F.sum("n").alias("n"))
        totals = np.where(used, smoothing, 0.0) + np.zeros((len(languages), 1))
        for r in found.toLocalIterator():
            totals[r["k"], r["piece"]] += r["n"]
        with np.errstate(divide="ignore"):
            logs = np.log(totals / totals.sum(axis=1, keepdims=True))
    return LanguageModel(languages, logs, pieces)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> F.Column:
    """Whether a document is kept from learning: the CRC-32 of its id as text is divisible by ``folds``. A null id is."""
    return F.coalesce(F.crc32(col(doc_id).cast("string")) % folds == 0, F.lit(True))
