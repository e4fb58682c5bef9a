"""Lines of diffs, a batch of diffs at a time.

A diff is cut in its own cell: line starts, kinds and running line numbers are arrays over the bytes of a batch, so nothing
is shuffled or sorted and a line costs the same however long its hunk is. Sections, paths and hunks are those of
``functions.diffs``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patchloom.operators.pulls import PULL_KEY

#: Bytes of diff text worked on at once (a longer diff is worked on alone), and rows handed back at once.
SLICE_BYTES, ROWS = 1 << 20, 1 << 16

_PLUS, _MINUS, _REMARK = b"+-\\"
_KINDS = pa.array([" ", "+", "-"])
#: Bytes of a character by its first one.
_WIDTH = np.ones(256, np.int64)
_WIDTH[0xC2:0xE0], _WIDTH[0xE0:0xF0], _WIDTH[0xF0:0xF5] = 2, 3, 4

# The patterns of functions.diffs, on bytes.
_PATH = re.compile(rb'^(?:--- "?a/(?=[^\n]*\n\+\+\+ /dev/null)|\+\+\+ "?b/)([^\t\n"]+)', re.M)
_NAMED_PATH = re.compile(rb'diff --git [^\n]* "?b/([^\n"]+)')
_HEADER = re.compile(rb"@@ -([0-9]+)(?:,[0-9]+)? \+([0-9]+)(?:,[0-9]+)? @@")


@dataclass
class Hunks:
    """The hunks of some diffs: diff, numbers of file, of hunk in the file and of hunk in the diff (from 1), path, first lines."""

    diff: np.ndarray
    file_no: np.ndarray
    hunk_no: np.ndarray
    number: np.ndarray
    path: pa.Array
    old_start: np.ndarray
    new_start: np.ndarray

    def columns(self, at: np.ndarray) -> list[pa.Array]:
        names = pa.array([f"HUNK_{n}" for n in self.number.tolist()], pa.string())
        at = pa.array(at)
        return [pa.array(self.file_no).take(at), pa.array(self.hunk_no).take(at), names.take(at), self.path.take(at)]


_HUNK_COLUMNS = "file_no bigint, hunk_no bigint, hunk_id string, path string"


@dataclass
class Lines:
    """The lines of some hunks, remarks left out: hunk, place in it (remarks counted), bytes from ``begin`` to ``end`` of ``data`` without the
    sign, 0 for context, 1 for ``+``, 2 for ``-``, and how many lines of either side lie before."""

    data: np.ndarray
    hunk: np.ndarray
    pos: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    old: np.ndarray
    new: np.ndarray


def _number(digits: bytes) -> int:
    """A number of a header; one past 64 bits reads as 1, like one that is not there."""
    n = int(digits) if len(digits) < 4000 else 1 << 63
    return n if n < 1 << 63 else 1


def _rank(group: np.ndarray) -> np.ndarray:
    """The place of each element among its equal neighbours, from 0."""
    return np.arange(len(group)) - np.searchsorted(group, group)


def cut(diffs: pa.Array) -> tuple[Hunks, Lines]:
    """Hunks and lines of some diff texts; a null has none. Only a line feed ends a line; one at the end begins no other line."""
    diffs = pa.compute.fill_null(diffs, "").cast(pa.large_string())
    _, offsets, held = diffs.buffers()
    bounds = np.frombuffer(offsets, np.int64)[diffs.offset: diffs.offset + len(diffs) + 1]
    data = np.zeros(0, np.uint8) if held is None else np.frombuffer(held, np.uint8)[bounds[0]: bounds[-1]]
    bounds, whole = bounds - bounds[0], data.tobytes()
    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([bounds[:-1], breaks + 1]), kind="stable")
    begin = begin[(begin < len(data)) & (np.diff(begin, prepend=-1) > 0)]
    diff = np.searchsorted(bounds, begin, side="right") - 1
    end = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, begin)], bounds[diff + 1])
    sign = np.where(end > begin, data[begin], 32)

    def starts(first: int, is_one: Callable[[bytes], bool], size: int) -> np.ndarray:
        at = np.flatnonzero(sign == first)
        return at[np.fromiter((is_one(whole[b: b + size]) for b in begin[at].tolist()), bool, len(at))]

    # lines that begin a file, the file of every line (-1: none), lines that begin a hunk, the hunk of every line below one
    opens = starts(ord("d"), b"diff --git ".__eq__, 11)
    n = np.arange(len(begin))
    file = np.searchsorted(opens, n, side="right") - 1
    if len(opens):
        file[diff[opens[file]] != diff] = -1
    heads = starts(ord("@"), lambda s: s[:4] == b"@@ -" and s[4:].isdigit(), 5)
    heads = heads[file[heads] >= 0]
    hunk = np.searchsorted(heads, n, side="right") - 1
    body = np.zeros(len(begin), bool)
    if len(heads):
        body = (hunk >= 0) & (file >= 0) & (file[heads[hunk]] == file) & (heads[hunk] != n)
    of = file[heads]
    path: dict[int, bytes] = {}
    for f, upto in zip(of.tolist(), begin[heads].tolist()):
        if f not in path:
            head = whole[int(begin[opens[f]]): upto].split(b"\n@@ -", 1)[0]
            found = _PATH.search(head) or _NAMED_PATH.match(head)
            path[f] = found[1] if found else b""
    numbers = [(_number(m[1]), _number(m[2])) if (m := _HEADER.match(whole, b, e)) else (1, 1) for b, e in zip(begin[heads].tolist(), end[heads].tolist())]
    old_start, new_start = np.array(numbers, np.int64).reshape(-1, 2).T
    first_file = np.searchsorted(diff[opens], diff[heads])  # the first file of each hunk's diff
    hunks = Hunks(
        diff[heads], of - first_file + 1, _rank(of) + 1, _rank(diff[heads]) + 1,
        pa.array([path[f] for f in of.tolist()], pa.binary()).cast(pa.string()), old_start, new_start)

    begin, end, sign, hunk = begin[body], end[body], sign[body], hunk[body]
    first = np.searchsorted(hunk, hunk)

    def before(counts: np.ndarray) -> np.ndarray:
        sums = np.cumsum(counts) - counts
        return sums - sums[first]

    told = sign != _REMARK
    old, new = before((told & (sign != _PLUS)).astype(np.int64)), before((told & (sign != _MINUS)).astype(np.int64))
    pos, kind = np.arange(len(hunk)) - first, np.where(sign == _PLUS, 1, np.where(sign == _MINUS, 2, 0))
    begin = np.minimum(begin + np.where(end > begin, _WIDTH[sign], 0), end)
    return hunks, Lines(data, *(x[told] for x in (hunk, pos, begin, end, kind, old, new)))


def _texts(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The stretches of ``data`` as an array of texts."""
    size = end - begin
    ends = np.cumsum(size)
    inside = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[inside]))


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows (first, number) that hold about ``SLICE_BYTES`` of text."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        upto = max(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, side="right")), at + 1)
        yield at, upto - at
        at = upto


def _unfolded(diffs: DataFrame, added: str, work: Callable) -> DataFrame:
    """The rows that ``work`` makes of hunks and lines of ``diff_text``, each with the keys of its pull request and hunk."""
    source = diffs.select(*PULL_KEY, "diff_text")
    schema = T.StructType([*source.schema.fields[:-1], *T.StructType.fromDDL(f"{_HUNK_COLUMNS}, {added}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(PULL_KEY))
            for start, length in _parts(texts):
                hunks, lines = cut(texts.slice(start, length))
                keys = batch.slice(start, length).select(PULL_KEY)
                for hunk, columns in work(hunks, lines):
                    kept = keys.take(pa.array(hunks.diff[hunk]))
                    yield pa.RecordBatch.from_arrays([*kept.columns, *hunks.columns(hunk), *columns], names=schema.names)

    return source.mapInArrow(run, schema)


def unfolded_lines(diffs: DataFrame) -> DataFrame:
    """One row per line of every hunk, remarks left out: pos, kind, old_line, new_line, text."""

    def work(hunks: Hunks, lines: Lines):
        for lo in range(0, len(lines.hunk), ROWS):
            hunk, pos, begin, end, kind, old, new = (
                x[lo: lo + ROWS] for x in (lines.hunk, lines.pos, lines.begin, lines.end, lines.kind, lines.old, lines.new))
            yield hunk, [
                pa.array(pos), _KINDS.take(pa.array(kind)), pa.array(hunks.old_start[hunk] + old, mask=kind == 1),
                pa.array(hunks.new_start[hunk] + new, mask=kind == 2), _texts(lines.data, begin, end)]

    return _unfolded(diffs, "pos bigint, kind string, old_line bigint, new_line bigint, text string", work)
