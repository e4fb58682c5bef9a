"""Piece lattices of many words side by side, as arrays of edges."""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np

from patchloom.llm.hashing import run_hashes
from patchloom.llm.vocabulary import PIECE_BITS, matcher


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Automaton:
    """Finds pieces by an Aho-Corasick automaton."""

    def __init__(self, pieces: tuple[tuple[str, int], ...]):
        self.automaton = matcher(pieces)

    def inside(self, text: str, points: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, id) of every piece in ``text`` that fits into the ``room`` (characters) left in its word."""
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64)
        last, found = found[::2], found[1::2]
        length = found & ((1 << PIECE_BITS) - 1)
        start = last - length + 1
        fits = length <= room[start]
        return start[fits], length[fits], found[fits] >> PIECE_BITS


class Hashed:
    """Finds pieces by their hash, a length at a time."""

    def __init__(self, pieces: tuple[tuple[str, int], ...]):
        sizes = np.fromiter((len(p) for p, _ in pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        hashes = run_hashes(code_points("".join(p for p, _ in pieces)), ends - sizes, ends)
        ids = np.fromiter((i for _, i in pieces), np.int64, len(pieces))
        self.tables = []
        for n in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == n)
            at = at[np.argsort(hashes[at])]
            seen = np.zeros(1 << 18, dtype=bool)
            seen[hashes[at] >> np.uint64(46)] = True
            self.tables.append((n, hashes[at], ids[at], seen))

    def inside(self, text: str, points: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, id) of every piece in ``text`` that fits into the ``room`` (characters) left in its word."""
        starts, lengths, found = [], [], []
        at = np.arange(len(points))
        for n, hashes, ids, seen in self.tables:
            at = at[room[at] >= n]
            h = run_hashes(points, at, at + n)
            maybe = np.flatnonzero(seen[h >> np.uint64(46)])
            place = np.minimum(np.searchsorted(hashes, h[maybe]), len(hashes) - 1)
            same = hashes[place] == h[maybe]
            starts.append(at[maybe[same]])
            lengths.append(np.full(len(starts[-1]), n))
            found.append(ids[place[same]])
        return np.concatenate(starts), np.concatenate(lengths), np.concatenate(found)


@lru_cache(maxsize=2)
def hashed(pieces: tuple[tuple[str, int], ...]) -> Hashed:
    return Hashed(pieces)


class Lattice:
    """All pieces inside some non-empty words. A character that is no piece alone also gives an edge, of piece -1, so every word
    has a segmentation.

    Edges are ordered by how far into its word they end, then by word, then by length: a step at a time, all words side by side.
    """

    def __init__(self, words: list[str], finder):
        self.text = text = "".join(words)
        points = code_points(text)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.concatenate([[0], np.cumsum(sizes)])  # characters before each word
        word_at = np.repeat(np.arange(len(words)), sizes)
        start, size, piece = finder.inside(text, points, self.first[word_at + 1] - np.arange(len(points)))
        alone = np.zeros(len(points), dtype=bool)
        alone[start[size == 1]] = True
        bare = np.flatnonzero(~alone)
        start = np.concatenate([start, bare])
        size = np.concatenate([size, np.ones(len(bare), np.int64)])
        piece = np.concatenate([piece, np.full(len(bare), -1)])
        word = word_at[start]
        depth = start + size - self.first[word]
        order = np.argsort((depth * len(words) + word) * (int(size.max(initial=0)) + 1) + size, kind="stable")
        self.start, self.piece, self.word, depth = start[order], piece[order], word[order], depth[order]
        self.end = self.start + size[order]
        self.steps = np.concatenate([[0], np.cumsum(np.bincount(depth, minlength=1)[1:])]).tolist()
        self.bare = np.flatnonzero(self.piece < 0)
        # node of character boundary x in word w: x + w, so that every word has its own first node
        self.source, self.target = self.start + self.word, self.end + self.word
        self.begin, self.last = self.first[:-1] + np.arange(len(words)), self.first[1:] + np.arange(len(words))
        self.nodes = len(text) + len(words)
        # edges with one target are neighbours: where each such group begins, and which groups a step has
        self.group = np.flatnonzero(np.r_[True, self.target[1:] != self.target[:-1]]) if len(self.target) else np.zeros(0, np.int64)
        self.group_steps = np.searchsorted(self.group, self.steps).tolist()

    def groups(self):
        """For every step: its edges (from, to), and where the groups of one target begin in it."""
        for lo, hi, a, b in zip(self.steps[:-1], self.steps[1:], self.group_steps[:-1], self.group_steps[1:]):
            if hi > lo:
                yield lo, hi, self.group[a:b]

    def bare_bytes(self) -> list[bytes]:
        """The characters of the edges of piece -1."""
        return [self.text[i].encode("utf-8", "surrogatepass") for i in self.start[self.bare].tolist()]

    def best(self, score: np.ndarray, second: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Viterbi over all words: (best score of every node, the edge it came by, second best score of every node).

        Of equal scores the longest last piece wins.
        """
        top = np.zeros(self.nodes)
        via = np.full(self.nodes, -1)
        next_top = np.full(self.nodes, -np.inf) if second else None
        for lo, hi, group in self.groups():
            source, s, at = self.source[lo:hi], score[lo:hi], group - lo
            reached = top[source] + s
            most = np.maximum.reduceat(reached, at)
            where = np.where(reached == np.repeat(most, np.diff(np.r_[at, hi - lo])), np.arange(lo, hi), -1)
            edge = np.maximum.reduceat(where, at)
            target = self.target[group]
            top[target], via[target] = most, edge
            if second:
                reached[edge - lo] = -np.inf
                next_top[target] = np.maximum.reduceat(np.maximum(reached, next_top[source] + s), at)
        return top, via, next_top

    def paths(self, via: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The edges of every word's best path, end to end in order, and how many each word has."""
        node, alive = self.last.copy(), np.arange(len(self.last))
        words, edges = [], []
        while len(alive):
            edge = via[node]
            words.append(alive)
            edges.append(edge)
            node = self.source[edge]
            go_on = node != self.begin[alive]
            node, alive = node[go_on], alive[go_on]
        if not edges:
            return np.zeros(0, np.int64), np.zeros(len(self.last), np.int64)
        words, edges = np.concatenate(words[::-1]), np.concatenate(edges[::-1])
        order = np.argsort(words, kind="stable")
        return edges[order], np.bincount(words, minlength=len(self.last))
