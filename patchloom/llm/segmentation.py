"""Piece encoding with the n best segmentations, and exact decoding.

The pieces and scores of a public model file span a lattice over a text; a segmentation's score is
the sum of its pieces' scores. No piece runs over the start of a word, so the lattice falls apart at
word starts. In each word a forward Viterbi pass gives the best score up to every character; for a search
from the word's end backwards these scores are exact estimates of what is still to come, so A-star
meets complete segmentations best first and stops after n. The n best of a text are then combined
from those of its words, again best first, taking only words whose second best costs least.

Unknown characters become byte pieces, spaces the space mark, so decoding gives the text back.
One pass over the rows, no shuffle; what is known of words is remembered inside a task, within bounds.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.lattice import Lattice, hashed
from patchloom.llm.rows import with_text_columns
from patchloom.llm.vocabulary import DEFAULT_VOCABULARY, PIECE_BITS, SPACE, UNKNOWN_PENALTY, Vocabulary, load_vocabulary, matcher, plain_pieces
from patchloom.llm.words import CACHE_BYTES, CutTexts, Remembered, kept

_LENGTH = (1 << PIECE_BITS) - 1
#: What is remembered of a word before its ids.
_HEAD = np.dtype([("score", "<f8"), ("gap", "<f8"), ("spelled", "<i4")])


@dataclass
class Encoded:
    """Segmentations of some texts: all ids end to end with the bounds of each text, best scores, alternatives (score, number
    of pieces, the words by place that differ from the best with their ids), and whether each word spells itself."""

    ids: np.ndarray
    bounds: np.ndarray
    scores: np.ndarray
    alternatives: list[list[dict]]
    spelled: np.ndarray


class Segmenter:
    """Best and n best segmentations over one vocabulary. Not shared between threads."""

    def __init__(self, vocabulary: Vocabulary):
        if not vocabulary.bytes or not vocabulary.words_part:
            raise ValueError("needs byte pieces, and pieces that keep to words")
        self.v = vocabulary
        self.scores = np.array(vocabulary.scores)
        self.automaton = matcher(plain_pieces(vocabulary))
        # the score of an unknown character comes from ordinary pieces; reserved ones carry no score of their own
        self.unknown = min(s for i in vocabulary.plain if (s := vocabulary.scores[i]) > -1e8) - UNKNOWN_PENALTY
        self.known = Remembered(self.learn, lambda found: 33 + len(found), CACHE_BYTES * 3 // 4)
        self.ways = {}
        self.plain = {i: p for i, p in zip(vocabulary.plain, (vocabulary.pieces[i] for i in vocabulary.plain))}
        self.byte_of = {i: b for b, i in enumerate(vocabulary.bytes)}

    def edges(self, word: str) -> list[list[tuple[int, int, float]]]:
        """For every end in the word, (start, id, score) by start; id -1 is an unknown character."""
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(len(word) + 1)]
        scores = self.v.scores
        for last, match in self.automaton.iter(word):
            i = match >> PIECE_BITS
            into[last + 1].append((last + 1 - (match & _LENGTH), i, scores[i]))
        for end in range(1, len(word) + 1):
            if not into[end] or into[end][-1][0] != end - 1:
                into[end].append((end - 1, -1, self.unknown))
        return into

    def _ids(self, word: str, path: Sequence[tuple[int, int, int]]) -> tuple[int, ...]:
        out: list[int] = []
        for start, end, i in path:
            if i < 0:
                out += [self.v.bytes[b] for b in word[start:end].encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
        return tuple(out)

    def learn(self, words: list[str]) -> list[bytes]:
        """Of some words, packed: best score, how much worse the second best is, whether the ids spell the word (``_HEAD``), and the ids
        of the best (of equals, with the longest last piece)."""
        lattice = Lattice(words, hashed(plain_pieces(self.v)))
        score = self.scores[lattice.piece]
        score[lattice.bare] = self.unknown
        top, via, second = lattice.best(score, second=True)
        edges, sizes = lattice.paths(via)
        ids = lattice.piece[edges].tolist()
        ends = np.cumsum(sizes)
        packed = np.array(ids, dtype="<i4").tobytes()
        paths = [packed[4 * a: 4 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        spelled = [True] * len(words)
        if len(lattice.bare) or "".join(map(self.v.pieces.__getitem__, ids)) != lattice.text:
            for w in np.unique(lattice.word[lattice.bare]).tolist():
                place = int(ends[w] - sizes[w])
                path = [(int(lattice.start[e]), int(lattice.end[e]), int(lattice.piece[e])) for e in edges[place: int(ends[w])]]
                paths[w] = np.array(self._ids(lattice.text, path), dtype="<i4").tobytes()
            spelled = [self.spelled(np.frombuffer(p, "<i4").tolist()) == w for p, w in zip(paths, words)]
        best = top[lattice.last]
        heads = np.empty(len(words), dtype=_HEAD)
        heads["score"], heads["gap"], heads["spelled"] = best, best - second[lattice.last], spelled
        heads, size = heads.tobytes(), _HEAD.itemsize
        return [heads[size * i: size * (i + 1)] + p for i, p in enumerate(paths)]

    def remembered_ways(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """``n_best`` of a word, remembered."""
        if n not in self.ways:
            cost = lambda ways: sum(180 + 40 * len(ids) for _, ids in ways)
            self.ways = {n: Remembered(lambda words: [self.n_best(w, n) for w in words], cost, CACHE_BYTES // 4)}
        return self.ways[n].of([word])[0]

    def n_best(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a word, best first; of equals, longer last pieces first. Fewer if there are fewer."""
        into = self.edges(word)
        ahead = [0.0]
        for end in range(1, len(word) + 1):
            ahead.append(max(ahead[start] + score for start, _, score in into[end]))
        out: list[tuple[float, tuple[int, ...]]] = []
        # (minus the score of the whole if the rest is best, order of arrival, where the suffix begins, its score, the suffix)
        queue: list[tuple] = [(-ahead[-1], 0, len(word), 0.0, None)]
        arrived = 1
        while queue and len(out) < n:
            rank, _, at, score, suffix = heapq.heappop(queue)
            if at == 0:
                path = []
                while suffix is not None:
                    piece, suffix = suffix
                    path.append(piece)
                out.append((-rank, self._ids(word, path)))
                continue
            for start, i, s in into[at]:
                heapq.heappush(queue, (-(ahead[start] + s + score), arrived, start, score + s, ((start, at, i), suffix)))
                arrived += 1
        return out

    def encode(self, texts: list[str], n: int = 1) -> Encoded:
        """The best segmentations of some texts, and the 2nd to n-th best ones."""
        cut = CutTexts(texts, always=True, runs=True)
        known, head = self.known.of(cut.words), _HEAD.itemsize
        heads = np.frombuffer(b"".join(found[:head] for found in known), dtype=_HEAD)
        flat = np.frombuffer(b"".join(found[head:] for found in known), dtype="<i4")
        size, at = (np.fromiter(map(len, known), np.int64, len(known)) - head) // 4, cut.at
        begin = np.cumsum(size) - size
        # the ids of every word in place: its run in ``flat``, one after the other
        sizes_in_place = size[at]
        run_end = np.cumsum(sizes_in_place)
        place = np.arange(int(run_end[-1]) if len(run_end) else 0)
        place += np.repeat(begin[at] - (run_end - sizes_in_place), sizes_in_place)
        score, gap = heads["score"], heads["gap"][at]
        spelled = cut.totals((heads["spelled"][at] == 0).astype(np.int64)) == 0
        totals, n_ids = cut.totals(score[at]), cut.totals(sizes_in_place)
        ways, lo = [], 0
        for row, hi in enumerate(cut.row_ends.tolist()):
            ways.append(self._alternatives(cut, gap[lo:hi], at[lo:hi], float(totals[row]), int(n_ids[row]), size, n) if n > 1 else [])
            lo = hi
        return Encoded(flat[place], np.concatenate([[0], np.cumsum(n_ids)]), totals, ways, spelled)

    def _alternatives(self, cut, gap, at, score: float, n_ids: int, size, n: int) -> list[dict]:
        # only words with the n - 1 smallest second-best gaps can be in the n best; of equal gaps the first ones are taken
        if len(gap) > n - 1:
            near = np.flatnonzero(gap <= np.partition(gap, n - 2)[n - 2])
            near = near[np.argsort(gap[near], kind="stable")][: n - 1]
        else:
            near = np.argsort(gap, kind="stable")
        options = [(k, self.remembered_ways(cut.words[at[k]], n)) for k in near.tolist() if gap[k] < np.inf]
        return [{
            "score": s, "n_pieces": n_ids + sum(len(x) - int(size[at[k]]) for k, x in changes),
            "changes": [{"word": k, "ids": list(x)} for k, x in changes]} for s, changes in self._combined(score, options, n)]

    @staticmethod
    def _combined(score: float, options: list, n: int) -> list:
        """The best choices of one segmentation per word, best first, without the first of all."""
        out = []
        queue = [(0.0, (0,) * len(options))]
        seen = {queue[0][1]}
        while queue and len(out) < n:
            cost, choice = heapq.heappop(queue)
            out.append((score - cost, [(k, ways[c][1]) for (k, ways), c in zip(options, choice) if c]))
            for j, (_, ways) in enumerate(options):
                c = choice[j] + 1
                after = (*choice[:j], c, *choice[j + 1:])
                if c < len(ways) and after not in seen:
                    seen.add(after)
                    heapq.heappush(queue, (cost + ways[c - 1][0] - ways[c][0], after))
        return out[1:]

    def spelled(self, ids: Sequence[int]) -> str:
        """What the ids spell, space marks and all."""
        out: list[str] = []
        held = bytearray()
        plain, byte_of = self.plain, self.byte_of
        for i in ids:
            piece = plain.get(i)
            if piece is None:
                if i in byte_of:
                    held.append(byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(piece)
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of some ids: marks become spaces, the first one is dropped."""
        text = self.spelled(ids).replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_ALTERNATIVE = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("n_pieces", T.LongType()),
    T.StructField("changes", T.ArrayType(T.StructType([
        T.StructField("word", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))),
])


def encoded(df: DataFrame, keep: list[str], text: str = "text", vocabulary: str = DEFAULT_VOCABULARY, n_best: int = 4) -> DataFrame:
    """Every row's kept columns as ``row``; ``ids`` and ``score`` of its best segmentation; ``alternatives``, the next ones up to
    ``n_best`` (score, number of pieces, and the words that differ, by place); and ``exact``, whether decoding the ids gives the
    text back. A null text has null ids and score and no alternatives and is exact; an empty one has no ids. A text that holds the
    space mark itself, which decoding turns into a space, is not exact. Repeated rows give repeated results, an empty table an empty one. A
    text is cut whole, however long; what is remembered of its words stays within ``CACHE_BYTES``."""
    pieces = load_vocabulary(vocabulary)
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("score", T.DoubleType()),
              T.StructField("alternatives", T.ArrayType(_ALTERNATIVE)), T.StructField("exact", T.BooleanType())]

    def make():
        segmenter = kept(f"segmenter {vocabulary}", lambda: Segmenter(pieces))

        def work(texts: pa.Array) -> list:
            values = texts.to_pylist()
            null = np.array([t is None for t in values])
            found = segmenter.encode([t or "" for t in values], n_best)
            ids = pa.ListArray.from_arrays(pa.array(found.bounds, pa.int32()), pa.array(found.ids), mask=pa.array(null))
            exact = found.spelled & ~np.array([SPACE in t if t else False for t in values])
            return [ids, pa.array(found.scores, mask=null), found.alternatives, pa.array(exact | null)]

        return work

    return with_text_columns(df, text, keep, fields, make)


def decoded(df: DataFrame, keep: list[str], ids: str = "ids", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Every row's kept columns as ``row`` and the ``text`` of its ids; null where the ids are null."""
    pieces = load_vocabulary(vocabulary)
    source = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([source.schema["row"], T.StructField("text", T.StringType())])

    def run(batches):
        segmenter = kept(f"segmenter {vocabulary}", lambda: Segmenter(pieces))
        for batch in batches:
            texts = [None if x is None else segmenter.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return source.mapInArrow(run, schema)
