"""Words of many texts at once: cut at spaces, told apart, each distinct word worked on once and remembered within bounds."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable
from typing import Any

import numpy as np
import pyarrow as pa

from patchloom.llm.hashing import run_hashes
from patchloom.llm.lattice import code_points
from patchloom.llm.vocabulary import SPACE

#: Words learned in one go.
AT_ONCE = 20_000
#: Bytes that a Python worker spends on what it remembers of words, whichever operator runs in it.
CACHE_BYTES = 64 << 20
#: Characters compared at a stroke.
_COMPARED = 1 << 18
_MARK = np.uint32(ord(SPACE))


def told_apart(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``points[start:end]`` told apart: where each distinct one stands first, and the place of every run among them.

    Runs fall together by hash and are then compared character by character; where two different ones share a hash, all are told apart by
    their characters alone.
    """
    _, first, at = np.unique(run_hashes(points, start, end), return_index=True, return_inverse=True)
    stands = first[at]
    again = np.flatnonzero(stands != np.arange(len(start)))
    sizes = (end - start)[again]
    same = bool((sizes == (end - start)[stands[again]]).all())
    ends, lo = np.cumsum(sizes), 0
    while same and lo < len(again):
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _COMPARED)), lo + 1)
        size, runs = sizes[lo:hi], again[lo:hi]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        same = bool((points[np.repeat(start[runs], size) + inside] == points[np.repeat(start[stands[runs]], size) + inside]).all())
        lo = hi
    if same:
        return first, at
    places: dict[bytes, int] = {}
    at = np.fromiter((places.setdefault(points[s:e].tobytes(), len(places)) for s, e in zip(start.tolist(), end.tolist())), np.int64, len(start))
    return np.unique(at, return_index=True)[1], at


class CutTexts:
    """Texts with space marks for spaces, one mark put before each (unless it begins with one and ``always`` is off), cut
    before marks: before every mark, or with ``runs`` before every run of marks. An empty text has no words.

    ``at`` gives each word's place among the distinct ones (``words``); ``row_ends`` where each text's words end.
    """

    def __init__(self, texts: Iterable[str], always: bool, runs: bool):
        marked = [t.replace(" ", SPACE) for t in texts]
        marked = [SPACE + t if t and (always or t[0] != SPACE) else t for t in marked]
        self.joined = "".join(marked)
        points = code_points(self.joined)
        ends = np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))
        begins = points == _MARK
        if runs:
            begins[1:] &= points[:-1] != _MARK
        inner = ends[:-1]
        begins[inner[inner < len(points)]] = True
        self.start = np.flatnonzero(begins)
        self.end = np.append(self.start[1:], len(points))[: len(self.start)]
        self.row_ends = np.searchsorted(self.start, ends)
        first, self.at = told_apart(points, self.start, self.end)
        self.words = [self.joined[s:e] for s, e in zip(self.start[first].tolist(), self.end[first].tolist())]

    def totals(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of a value per word in place."""
        sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])[np.append(0, self.row_ends)]
        return np.diff(sums)


def word_bytes(word: str) -> int:
    """About what a word costs as the key of a dictionary."""
    return 180 + (1 if word.isascii() else 2) * len(word)


class Remembered:
    """What is known of words, in two generations of half of ``room`` bytes each: where the young one is full it becomes the old one, whose words
    are forgotten unless they were met again. ``cost`` tells the bytes of a value."""

    def __init__(self, learn: Callable[[list[str]], list], cost: Callable[[Any], int], room: int = CACHE_BYTES):
        self.learn, self.cost, self.room, self.held = learn, cost, room, 0
        self.young: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def of(self, words: list[str]) -> list:
        """What is known of some distinct words, in their order."""
        out = list(map(self.young.get, words))
        new = []
        for i in [i for i, found in enumerate(out) if found is None]:
            found = out[i] = self.old.get(words[i])
            if found is None:
                new.append(i)
            else:
                self._keep(words[i], found)
        for j in range(0, len(new), AT_ONCE):
            part = new[j: j + AT_ONCE]
            for i, found in zip(part, self.learn([words[i] for i in part])):
                out[i] = found
                self._keep(words[i], found)
        return out

    def _keep(self, word: str, found: Any) -> None:
        size = word_bytes(word) + self.cost(found)
        if self.held + size > self.room // 2:
            self.young, self.old, self.held = {}, self.young, 0
        if size <= self.room // 2:
            self.young[word] = found
            self.held += size


_kept: dict[str, Any] = {}


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What this worker keeps under a name, so that tasks that follow each other share it. Only one thing is kept: the next operator
    that runs in the worker lets go of the last one's."""
    if name not in _kept:
        let_go()
        _kept[name] = make()
    return _kept[name]


def let_go() -> None:
    """Forgets what this worker kept and hands free memory back to the system. An operator that keeps nothing calls it as its tasks begin, so that
    it doesn't run beside what an earlier one left in a reused worker."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
