"""From diff text to patches, and to file, hunk and line tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import diffs
from patchloom.functions.paths import is_test_path
from patchloom.functions.text import once
from patchloom.operators.hunk_lines import unfolded_lines
from patchloom.operators.pulls import PULL_JOIN, PULL_KEY, head_commit

_FILE = [*PULL_KEY, "file_no"]
_HUNK = [*_FILE, "hunk_no"]


def diff_files(diffs_table: DataFrame) -> DataFrame:
    """One row per file of every diff: file_no (from 1), path, file_diff."""
    return diffs_table.select(
        *PULL_KEY, F.posexplode(diffs.sections(F.col("diff_text"))).alias("pos", "file_diff")
    ).select(
        *PULL_KEY,
        (F.col("pos") + 1).cast("bigint").alias("file_no"),
        diffs.section_path(F.col("file_diff")).alias("path"),
        "file_diff",
    )


def file_line_counts(diffs_table: DataFrame) -> DataFrame:
    """Added and removed lines per file; counted in the diff cell, without a shuffle."""
    return diff_files(diffs_table).select(
        *_FILE, "path",
        diffs.lines_added(F.col("file_diff")).alias("added"),
        diffs.lines_removed(F.col("file_diff")).alias("removed"),
    )


def diff_hunks(diffs_table: DataFrame) -> DataFrame:
    """One row per hunk: its running name ``HUNK_n`` within the diff, positions and counts, and its text."""
    text = F.col("hunk")
    return (
        diffs_table.select(*PULL_KEY, F.posexplode(diffs.hunk_entries(F.col("diff_text"))).alias("pos", "at"))
        .select(
            *PULL_KEY,
            F.concat(F.lit("HUNK_"), (F.col("pos") + 1).cast("string")).alias("hunk_id"),
            "at.file_no", "at.hunk_no", "at.path", "at.hunk",
        )
        .select(
            *_HUNK, "hunk_id", "path",
            diffs.hunk_number(text, 1).alias("old_start"),
            diffs.hunk_number(text, 2).alias("old_count"),
            diffs.hunk_number(text, 3).alias("new_start"),
            diffs.hunk_number(text, 4).alias("new_count"),
            "hunk",
        )
    )


def diff_lines(diffs_table: DataFrame) -> DataFrame:
    """One row per hunk line: kind (``+``, ``-`` or blank for context) and its line numbers.

    Lines are unfolded from the cell of their diff, a batch of diffs at a time. Nothing is shuffled or sorted.
    """
    return unfolded_lines(diffs_table)


def change_blocks(diffs_table: DataFrame) -> DataFrame:
    """Maximal runs of changed lines, as line ranges on the old side.

    They are counted inside the cell of a hunk; lines are not unfolded. A block that only
    inserts is anchored to the old line before it.
    """
    kept = [*_HUNK, "hunk_id", "path", "old_start"]
    rows = diff_hunks(diffs_table).select(*kept, once("_told", diffs.without_remarks(F.col("hunk"))))
    rows = rows.select(*kept, once("_changes", diffs.changes(F.col("_told"))))
    return rows.select(*_HUNK, "hunk_id", "path", F.inline(diffs.changed_blocks(F.col("_changes"), F.col("old_start"))))


def blocks_by_hunk(diffs_table: DataFrame) -> DataFrame:
    """The blocks of ``change_blocks``, in one row per diff: ``blocks``, an array per hunk, in the order of their names. Null where there is no diff."""
    rows = diffs_table.select(*PULL_KEY, once("_files", diffs.files_text(F.col("diff_text"))))
    rows = rows.select(*PULL_KEY, once("_told", diffs.without_remarks(F.col("_files"))))
    stretches = F.transform(diffs.hunk_texts(F.col("_told")), diffs.changes)
    return rows.select(*PULL_KEY, once("blocks", F.zip_with(stretches, diffs.hunk_starts(F.col("_told")), diffs.changed_blocks)))


def hunk_counts(diffs_table: DataFrame) -> DataFrame:
    """The number of hunks of every diff: hunk names run from 1 to it."""
    return diffs_table.select(*PULL_KEY, F.size(diffs.hunk_texts(diffs.files_text(F.col("diff_text")))).alias("hunks"))


def _parsed(rows: DataFrame, text: Column) -> DataFrame:
    """Adds what ``parse_diffs`` tells of a diff text, within the row.

    Arrays of plain texts, each worked out once: an array function that makes structs costs several times what it does with them.
    """
    kept = rows.columns
    rows = rows.select("*", diffs.cut_texts(text).alias("_cut"))
    rows = rows.select("*", diffs.heads(F.col("_cut")).alias("_heads"))
    rows = rows.select("*", diffs.hunk_text(F.col("_cut"), F.col("_heads")).alias("_hunks"), diffs.named_paths(F.col("_heads")).alias("_named"))
    rows = rows.select("*", diffs.head_paths(F.col("_heads"), F.col("_named")).alias("_paths"))
    tests = F.transform("_paths", lambda p: is_test_path(p))
    rows = rows.select("*", once("_tests", tests))  # a filter on a patch works out no path again
    rows = rows.select("*", F.transform("_tests", lambda t: ~t).alias("_others"))
    return rows.select(
        *kept,
        diffs.joined_texts(F.col("_cut"), F.col("_others")).alias("fix_patch"),
        diffs.joined_texts(F.col("_cut"), F.col("_tests")).alias("test_patch"),
        F.array_distinct("_paths").alias("modified_files"),
        diffs.changed_lines(F.col("_hunks"), "+").alias("lines_added"),
        diffs.changed_lines(F.col("_hunks"), "-").alias("lines_removed"),
    )


def parse_diffs(compare_diffs: DataFrame) -> DataFrame:
    """fix_patch, test_patch, modified_files, lines_added and lines_removed of every diff, within its row."""
    return _parsed(compare_diffs.select(*PULL_KEY, "diff_text"), F.col("diff_text")).drop("diff_text")


def is_comparable() -> Column:
    """Whether a pull request has a base and a head commit to compare."""
    head = head_commit(F.col("commits"))["sha"]
    return (F.coalesce(F.col("base.sha"), F.lit("")) != "") & (F.coalesce(head, F.lit("")) != "")


def extract_patches(
    pulls: DataFrame, compare_diffs: DataFrame, parts: str = "diff_text", text_of: Callable[[str], Column] = F.col,
) -> DataFrame:
    """Add fix_patch, test_patch, modified_files, lines_added and lines_removed.

    A row without a base commit, commits or a diff gets empty values. The join on
    the pull request key is the only exchange. Whether a row can be compared is told
    before it, and diffs are parsed after it, so it sorts neither commits nor patches
    that nobody asks for. Where the text of a diff is made of something narrower
    (``parts``), ``text_of`` makes it after the join, too.
    """
    empty = {
        "fix_patch": F.lit(""), "test_patch": F.lit(""), "modified_files": F.array().cast("array<string>"),
        "lines_added": F.lit(0).cast("bigint"), "lines_removed": F.lit(0).cast("bigint"),
    }
    rows = pulls.withColumn("_comparable", is_comparable()).join(
        compare_diffs.select(*PULL_KEY, F.col(parts).alias("_diff")), PULL_JOIN, "left")
    text = F.when(F.col("_comparable"), text_of("_diff"))
    return _parsed(rows, text).drop("_comparable", "_diff").withColumns({
        name: F.coalesce(F.col(name), none) for name, none in empty.items()
    })


def has_fix_patch(patches: DataFrame) -> DataFrame:
    return patches.filter(F.coalesce(F.col("fix_patch"), F.lit("")) != "")
