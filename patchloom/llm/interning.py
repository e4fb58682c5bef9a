"""An open-addressed table over NumPy arrays that interns words and word n-grams of a batch of texts.

Keys are XXH64; a slot holds the occurrence that came to it first, and every later one is verified against it byte by byte
(words) or word number by word number (n-grams of words that were verified before), so a collision of hashes costs
a probe and never a wrong answer. All occurrences probe at once, one step of linear probing a round.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import xxhash

# The primes of XXH64 and the reversed polynomial of CRC-32.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_POLYNOMIAL = 0xEDB88320

#: Words from this many bytes on are hashed one by one.
_LONG = 32
#: Zero bytes that one step of a shifted checksum covers.
_SHIFTS = 64


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(rows: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of each row of a matrix of fewer than 32 bytes a row."""
    n, size = rows.shape
    h = np.full(n, np.uint64(seed) + _P5 + np.uint64(size), dtype=np.uint64)
    at = 0
    for _ in range(size // 8):
        lane = np.ascontiguousarray(rows[:, at: at + 8]).view("<u8").ravel()
        h = _turned(h ^ _turned(lane * _P2, 31) * _P1, 27) * _P1 + _P4
        at += 8
    if size - at >= 4:
        lane = np.ascontiguousarray(rows[:, at: at + 4]).view("<u4").ravel().astype(np.uint64)
        h = _turned(h ^ lane * _P1, 23) * _P2 + _P3
        at += 4
    for i in range(at, size):
        h = _turned(h ^ rows[:, i].astype(np.uint64) * _P5, 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def interned(keys: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The slot of every occurrence, and for every slot the occurrence that owns it (-1: empty).

    ``same(i, j)`` verifies occurrences i against j. The table is at most half full.
    """
    size = 1 << max(int(2 * len(keys) - 1).bit_length(), 1)
    owner = np.full(size, -1, dtype=np.int64)
    slot = np.empty(len(keys), dtype=np.int64)
    todo, at = np.arange(len(keys)), (keys & np.uint64(size - 1)).astype(np.int64)
    while len(todo):
        free = owner[at] < 0
        owner[at[free]] = todo[free]
        own = owner[at]
        found = keys[own] == keys[todo]
        found[found] = same(own[found], todo[found])
        slot[todo[found]] = at[found]
        todo, at = todo[~found], at[~found] + 1 & size - 1
    return slot, owner


def distinct_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For every word ``data[start:end]`` the place of the occurrence that stands for all equal ones."""
    sizes = end - start
    stands = np.empty(len(start), dtype=np.int64)
    by_size = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[by_size])) + 1
    long: dict[tuple[int, bytes], int] = {}
    for at in np.split(by_size, cuts) if len(by_size) else ():
        size = int(sizes[at[0]])
        if size >= _LONG:
            for i in at.tolist():
                word = data[start[i]: end[i]].tobytes()
                stands[i] = long.setdefault((xxhash.xxh64_intdigest(word), word), i)
            continue
        rows = data[start[at][:, None] + np.arange(size)]
        slot, owner = interned(xxh64(rows), lambda i, j, rows=rows: (rows[i] == rows[j]).all(axis=1))
        stands[at] = at[owner[slot]]
    return stands


def _byte_steps() -> np.ndarray:
    """Images of every byte in each of four places of a CRC-32 register after 0 to ``_SHIFTS`` zero bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), table >> np.uint32(1))
    out = np.empty((_SHIFTS + 1, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for i in range(_SHIFTS):
        out[i + 1] = (out[i] >> np.uint32(8)) ^ table[out[i] & np.uint32(255)]
    return out


_STEPS = _byte_steps()


def shifted(crc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Checksums as ``count`` more bytes change them: crc32(a + b) = shifted(crc32(a), len(b)) ^ crc32(b)."""
    crc, count = crc.copy(), count.copy()
    while True:
        step = np.minimum(count, _SHIFTS)
        crc = (_STEPS[step, 0, crc & np.uint32(255)] ^ _STEPS[step, 1, crc >> np.uint32(8) & np.uint32(255)]
               ^ _STEPS[step, 2, crc >> np.uint32(16) & np.uint32(255)] ^ _STEPS[step, 3, crc >> np.uint32(24)])
        count -= step
        if not count.any():
            return crc


class Grams:
    """All runs of 1 to ``most`` words of some texts, interned.

    ``bucket`` and ``count`` belong to slots; ``slot`` and ``row`` to occurrences (which slot, which text).
    """

    def __init__(self, words, most: int, buckets: int):
        stands = distinct_words(words.bytes, words.start, words.end)
        own = np.flatnonzero(stands == np.arange(len(stands)))
        raw = [words.bytes[s:e].tobytes() for s, e in zip(words.start[own].tolist(), words.end[own].tolist())]
        alone, after = np.zeros(len(stands), np.uint32), np.zeros(len(stands), np.uint32)
        alone[own] = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
        after[own] = np.fromiter((zlib.crc32(w, _SPACE) for w in raw), np.uint32, len(raw))
        sizes = words.end - words.start
        slots, rows, bucket, count, base = [], [], [], [], 0
        numbers = stands.astype("<u4")
        for k in range(1, most + 1):
            at = words.spans(k)
            packed = np.stack([numbers[at + j] for j in range(k)], axis=1) if len(at) else np.zeros((0, k), "<u4")
            slot, owner = interned(
                xxh64(packed.view(np.uint8)), lambda i, j, packed=packed: (packed[i] == packed[j]).all(axis=1))
            first = at[owner[owner >= 0]]
            crc = alone[stands[first]]
            for j in range(1, k):
                crc = shifted(crc, sizes[first + j] + 1) ^ after[stands[first + j]]
            held = np.zeros(len(owner), np.int64)
            held[owner >= 0] = crc % np.uint32(buckets)
            slots.append(slot + base)
            rows.append(words.row[at])
            bucket.append(held)
            count.append(np.bincount(slot, minlength=len(owner)))
            base += len(owner)
        self.slot, self.row = np.concatenate(slots), np.concatenate(rows)
        self.bucket, self.count = np.concatenate(bucket), np.concatenate(count)


_SPACE = zlib.crc32(b" ")
