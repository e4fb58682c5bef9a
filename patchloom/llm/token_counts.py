"""Token counts by a Viterbi pass that keeps counts instead of paths.

The tokenizer is a unigram model over the pieces and scores of a public model file, words cut at
spaces (the space mark leads the next word), bytes standing in for unknown characters. An
Aho-Corasick automaton lists the pieces that end at each character; every position keeps the best
score and the piece count of the path behind it. Ties follow the tokenizer exactly: a later path must
score strictly more, and paths to a position are tried by where their last piece starts, so of equals the
longest last piece wins.

One pass over the rows, no shuffle. Counts of words are kept for reuse inside a task, in bounded memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patchloom.llm.lattice import Automaton, Lattice
from patchloom.llm.rows import with_text_columns
from patchloom.llm.vocabulary import DEFAULT_VOCABULARY, UNKNOWN_PENALTY, Vocabulary, load_vocabulary
from patchloom.llm.words import CutTexts, Remembered, kept


class TokenCounter:
    """Counts the tokens of words and texts over one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.scores = np.array(vocabulary.scores)
        self.fallback = bool(vocabulary.bytes)
        self.unknown = min(vocabulary.scores) - UNKNOWN_PENALTY
        self.finder = Automaton(tuple((p, i) for i, p in enumerate(vocabulary.pieces) if p))
        self.known = Remembered(self.learn, lambda n: 32)

    def learn(self, words: list[str]) -> list[int]:
        """Tokens of some words, their space marks included."""
        lattice = Lattice(words, self.finder)
        score = self.scores[lattice.piece]
        score[lattice.bare] = self.unknown
        width = np.ones(len(score), dtype=np.int64)
        if self.fallback:
            width[lattice.bare] = [len(b) for b in lattice.bare_bytes()]
        top = np.zeros(lattice.nodes)
        count = np.zeros(lattice.nodes, dtype=np.int64)
        unknown = np.zeros(lattice.nodes, dtype=bool)
        for lo, hi, group in lattice.groups():
            reached = top[lattice.source[lo:hi]] + score[lo:hi]
            at = group - lo
            most = np.maximum.reduceat(reached, at)
            # edges of a group go by length: the last of the best is the one that starts first
            where = np.where(reached == np.repeat(most, np.diff(np.r_[at, hi - lo])), np.arange(lo, hi), -1)
            edge = np.maximum.reduceat(where, at)
            source, target, bare = lattice.source[edge], lattice.target[group], lattice.piece[edge] < 0
            step = width[edge]
            if not self.fallback:  # neighbouring unknown characters are one token
                step = np.where(bare & unknown[source], 0, step)
            top[target], count[target], unknown[target] = most, count[source] + step, bare
        return count[lattice.last].tolist()

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text; none in a null or empty one."""
        cut = CutTexts([t or "" for t in texts], always=False, runs=False)
        return cut.totals(np.array(self.known.of(cut.words), dtype=np.int64)[cut.at])


def token_counts(df: DataFrame, keep: list[str], text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Every row's kept columns as ``row`` and ``n_tokens``: null and empty texts have 0; repeated rows give repeated results; an empty
    table gives an empty one. A text is counted whole, however long. Equal scores are settled by the tokenizer's own rule (see above)."""
    pieces = load_vocabulary(vocabulary)

    def make():
        counter = kept(f"counter {vocabulary}", lambda: TokenCounter(pieces))
        return lambda texts: [pa.array(counter.counts(texts.to_pylist()))]

    return with_text_columns(df, text, keep, [T.StructField("n_tokens", T.LongType())], make)
