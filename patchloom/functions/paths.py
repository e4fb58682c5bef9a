"""File path rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom import fixed

# A keyword that holds a shorter one adds nothing to a substring test.
_SUBSTRINGS = [k for k in fixed.TEST_PATH_KEYWORDS if not any(o != k and o in k for o in fixed.TEST_PATH_KEYWORDS)]


def is_test_path(path: Column, whole_segments: bool = False) -> Column:
    """Whether a path is a test file.

    The rule is a substring test, so ``rtl/outbound_fifo.sv`` counts as one (it
    holds ``tb``). ``whole_segments`` asks instead for a directory or file stem
    that equals a keyword.
    """
    low = F.lower(path)
    if whole_segments:
        return low.rlike(r"(?:\A|/)(?:" + "|".join(fixed.TEST_PATH_KEYWORDS) + r")(?:[./]|\z)")
    return low.rlike("|".join(_SUBSTRINGS))


def suffix(path: Column) -> Column:
    """Lower-cased last suffix of the file name, with its dot; empty for none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)\z", 1))


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"[^/]*\z", 0), r"(?<=.)\.[^./]+\z", "")


def rtl_lang(path: Column) -> Column:
    """Language tag of a hardware source file, null for any other file."""
    tags = F.create_map(*[F.lit(x) for pair in fixed.RTL_LANGUAGES.items() for x in pair])
    return F.try_element_at(tags, suffix(path))


def is_doc_file(path: Column, doc_dirs: Column) -> Column:
    """Under one of the documentation roots (any root when none is set) and a documentation suffix."""
    under = F.exists(doc_dirs, lambda d: path.startswith(F.concat(F.rtrim(d, F.lit("/")), F.lit("/"))))
    no_roots = F.coalesce(F.size(doc_dirs), F.lit(0)) <= 0
    return suffix(path).isin(fixed.DOC_SUFFIXES) & (no_roots | F.coalesce(under, F.lit(False)))
