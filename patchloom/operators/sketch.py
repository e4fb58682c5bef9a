"""Key sketches: which rows of a wide table may belong to wanted keys, told in its scan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a sketch (2 MB), bits a key sets in its word, and sets of bits that a key may set.
WORDS, _PROBES, _MASKS = 1 << 18, 4, 1 << 12


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """The numbers of the word and of the set of bits of a key, by different bits of its hash."""
    return F.pmod(key, F.lit(words)), F.pmod(F.shiftrightunsigned(key, 40), F.lit(_MASKS))


def _hash(columns: list[Column]) -> Column:
    """Keys are told apart by their texts."""
    return F.xxhash64(*[c.cast("string") for c in columns])


def _mask(number: Column) -> Column:
    """A set of bits by its number (bigint)."""
    mixed, mask = F.xxhash64(number), F.lit(0).cast("bigint")
    for i in range(_PROBES):
        bit = F.pmod(F.shiftrightunsigned(mixed, 6 * i), F.lit(64)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


def key_sketch(keys: DataFrame, columns: list[str], words: int = WORDS) -> Callable[..., Column]:
    """A condition on key columns that holds for every key of ``keys``, and for few others.

    The sketch is a Bloom filter blocked by words, of fixed size (``words`` times 8 bytes, whatever the number of keys), built by one
    aggregate and read as a scalar subquery: a filter with it runs in the scan of the other table, before any exchange of its
    rows. At 16 bits a key (a million keys by default) two or three other rows in a hundred pass; with more keys more do, so an exact join
    has to follow. A key with a null is never met by an equi-join and may be reported or not.
    """
    word, bits = _place(F.col("_key"), words)
    every = keys.sparkSession.range(words).select("id", F.lit(0).cast("bigint").alias("mask"))
    placed = keys.select(_hash([F.col(c) for c in columns]).alias("_key")).select(word.alias("id"), _mask(bits).alias("mask"))
    masks = placed.unionAll(every).groupBy("id").agg(F.bit_or("mask").alias("word"))
    whole = masks.agg(F.array_sort(F.collect_list(F.struct("id", "word"))).alias("w"))
    # The sets of bits follow the words. To look one up takes the hash once; a condition that holds the hash many times makes the code of a scan
    # longer than what the virtual machine compiles (8,000 bytes of a method), and the scan is interpreted from then on.
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(_MASKS - 1).cast("bigint"))
    held = whole.select(F.concat(F.transform("w", lambda x: x["word"]), F.transform(numbers, _mask))).scalar()

    def may_hold(*key: Column) -> Column:
        word, bits = _place(_hash(list(key)), words)
        left = F.bitwise_not(F.element_at(held, (word + 1).cast("int")))
        return left.bitwiseAND(F.element_at(held, (bits + (words + 1)).cast("int"))) == 0

    return may_hold
