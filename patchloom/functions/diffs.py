"""Unified diff text inside one row.

A pull request's diff arrives as one cell, so files, counts and patches come
from array expressions on that cell: nothing is exploded and no diff text is
shuffled. In every pattern only a line feed ends a line (flag d), since source
lines may hold other line-break characters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom.functions.paths import is_test_path
from patchloom.functions.text import none_if_empty

_FILE_START = "diff --git "
_HUNK_MARK = "@@ -"
_HUNK_START = r"(?md)^(?=@@ -[0-9])"
#: More elements than an array holds, for slices that go to the end.
_EVERY = 1 << 30
HUNK_HEADER = r"\A@@ -([0-9]+)(?:,([0-9]+))? \+([0-9]+)(?:,([0-9]+))? @@"


def sections(diff_text: Column) -> Column:
    """One text per file of a diff, in file order.

    Cut at a plain text, which is looked for by leaps, not at a place that is tried behind every character.
    """
    def of(cut: Column) -> Column:
        last = F.size(cut) - 2
        return F.transform(F.slice(cut, 2, F.size(cut)), lambda s, i: F.concat(
            F.lit(_FILE_START), s, F.when(i < last, "\n").otherwise("")))

    return F.flatten(F.transform(F.array(F.split(F.concat(F.lit("\n"), diff_text), "\n" + _FILE_START)), of))


# The new path; for a deleted file, whose new side is /dev/null, the old one.
_PATH = r'(?md)^(?:--- "?a/(?=[^\n]*\n\+\+\+ /dev/null)|\+\+\+ "?b/)([^\t\n"]+)'
# The path in the first line, for files without hunks.
_NAMED_PATH = r'\Adiff --git [^\n]* "?b/([^\n"]+)'


def _head(section: Column) -> Column:
    return F.substring_index(section, "\n@@ -", 1)


def _paths_of(entries: Column) -> Column:
    """Adds ``path`` to an array of (head, ...): the new path, or the old one of a deleted file, or
    the first line's where there are no hunks."""
    found = F.transform(entries, lambda f: f.withField("path", F.regexp_extract(f["head"], _PATH, 1)))
    return F.transform(found, lambda f: f.withField("path", F.when(f["path"] != "", f["path"]).otherwise(
        F.regexp_extract(f["head"], _NAMED_PATH, 1))))


def section_path(section: Column) -> Column:
    """Path of one file of a diff."""
    return F.element_at(_paths_of(F.array(F.struct(_head(section).alias("head")))), 1)["path"]


def paths(diff_text: Column) -> Column:
    """Distinct paths of a diff, in order of first appearance; nothing else of the files is read.

    Arrays of plain texts: with structs in them, the same functions cost several times as much.
    """
    path = lambda h: F.coalesce(none_if_empty(F.regexp_extract(h, _PATH, 1)), F.regexp_extract(h, _NAMED_PATH, 1))
    return F.array_distinct(F.transform(heads(cut_texts(diff_text)), path))


def _lines_starting(text: Column, sign: str) -> Column:
    # Dropping the sign from every line start shortens the text by one byte per line.
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n" + sign), F.lit("\n")))


def _changed_lines(section: Column, head: Column, sign: str) -> Column:
    return (_lines_starting(section, sign) - _lines_starting(head, sign)).cast("bigint")


def lines_added(section: Column) -> Column:
    return _changed_lines(section, _head(section), "+")


def lines_removed(section: Column) -> Column:
    return _changed_lines(section, _head(section), "-")


def cut_texts(diff_text: Column) -> Column:
    """The file texts of a diff without their first word and the line break before the next file: put together, nothing need be added to each."""
    cut = F.split(F.concat(F.lit("\n"), diff_text), "\n" + _FILE_START)
    return F.slice(cut, 2, F.size(cut))


def joined_texts(cut: Column, wanted: Column) -> Column:
    """The wanted ones (an array of truth values, as a plain column) of cut texts, as they stand in the diff."""
    texts = F.array_join(F.zip_with(cut, wanted, lambda s, w: F.when(w, s)), "\n" + _FILE_START)
    last = F.try_element_at(wanted, F.lit(-1))
    return F.when(F.array_contains(wanted, True), F.concat(F.lit(_FILE_START), texts, F.when(last, "").otherwise("\n"))).when(
        wanted.isNotNull(), "")


def heads(cut: Column) -> Column:
    """What stands before the hunks, for each of the cut texts."""
    return F.transform(cut, lambda s: F.concat(F.lit(_FILE_START), _head(s)))


def named_paths(heads_of: Column) -> Column:
    """The path that the file header of each head names; empty where it has none."""
    return F.transform(heads_of, lambda h: F.regexp_extract(h, _PATH, 1))


def head_paths(heads_of: Column, named: Column) -> Column:
    """The path of each head: the named one, or the first line's."""
    return F.zip_with(heads_of, named, lambda h, n: F.when(n != "", n).otherwise(F.regexp_extract(h, _NAMED_PATH, 1)))


def hunk_text(cut: Column, heads_of: Column) -> Column:
    """What follows the heads, as one text; taken by bytes, which are not counted as characters are. It is empty or begins with a hunk
    header for each file, so no sign is found across two of them."""
    rest = lambda s, h: F.substring(s.cast("binary"), F.octet_length(h) - len(_FILE_START) + 1, F.octet_length(s)).cast("string")
    return F.array_join(F.zip_with(cut, heads_of, rest), "")


def changed_lines(hunk_text_of: Column, sign: str) -> Column:
    """Lines of one sign in the hunks of a diff."""
    return _lines_starting(hunk_text_of, sign).cast("bigint")


def file_entries(diff_text: Column) -> Column:
    """Array of (path, is_test, added, removed, file_diff), in file order.

    Built in steps, each of which reads what the one before has worked out.
    """
    cut = F.transform(sections(diff_text), lambda s: F.struct(_head(s).alias("head"), s.alias("file_diff")))
    return F.transform(_paths_of(cut), lambda f: F.struct(
        f["path"].alias("path"),
        is_test_path(f["path"]).alias("is_test"),
        _changed_lines(f["file_diff"], f["head"], "+").alias("added"),
        _changed_lines(f["file_diff"], f["head"], "-").alias("removed"),
        f["file_diff"].alias("file_diff"),
    ))


def hunks(section: Column) -> Column:
    """Hunk texts of one file, header line first, in order."""
    return F.filter(F.split(section, _HUNK_START), lambda h: h.startswith("@@ -"))


def all_hunks(diff_text: Column) -> Column:
    """Hunk texts of a whole diff, in order."""
    return F.flatten(F.transform(sections(diff_text), hunks))


def hunk_entries(diff_text: Column) -> Column:
    """Array of (file_no, hunk_no, path, hunk) over a whole diff, in order; numbers start at 1."""
    cut = F.transform(sections(diff_text), lambda s: F.struct(section_path(s).alias("path"), hunks(s).alias("hunks")))
    number = lambda i: (i + 1).cast("bigint")
    return F.flatten(F.transform(cut, lambda f, n: F.transform(f["hunks"], lambda h, i: F.struct(
        number(n).alias("file_no"), number(i).alias("hunk_no"), f["path"].alias("path"), h.alias("hunk")))))


def hunk_list(diff_text: Column) -> Column:
    """JSON array with one ``{"HUNK_n": code}`` object per hunk; numbering starts at 1."""
    named = F.transform(
        all_hunks(diff_text),
        lambda h, i: F.create_map(F.concat(F.lit("HUNK_"), (i + 1).cast("string")), h),
    )
    return F.to_json(named)


def hunk_number(hunk: Column, group: int) -> Column:
    """One number of a hunk header; a missing count reads as 1."""
    text = F.regexp_extract(hunk, HUNK_HEADER, group)
    return F.coalesce(none_if_empty(text).try_cast("bigint"), F.lit(1).cast("bigint"))


def hunk_body(hunk: Column) -> Column:
    """Array of the lines below the header, without the line break that ends the last one."""
    breaks = F.octet_length(hunk) - F.octet_length(F.replace(hunk, F.lit("\n"), F.lit("")))
    return F.slice(F.split(hunk, "\n"), 2, breaks - F.endswith(hunk, F.lit("\n")).cast("int"))


def changed_text(patch: Column) -> Column:
    """The added and removed lines of a patch, without its file headers, as one text."""
    lines = F.flatten(F.transform(all_hunks(patch), hunk_body))
    changed = F.filter(lines, lambda x: x.startswith("+") | x.startswith("-"))
    return F.array_join(F.transform(changed, lambda x: F.substring(x, 2, 2147483647)), "\n")


def files_text(diff_text: Column) -> Column:
    """What follows the first word of the first file: no hunk stands before it. Empty where there is no file."""
    files = F.get(F.split(F.concat(F.lit("\n"), diff_text), "\n" + _FILE_START, 2), 1)
    return F.coalesce(files, F.when(diff_text.isNotNull(), ""))


def without_remarks(text: Column) -> Column:
    """A text without the lines that are remarks; ``text`` should be a plain column."""
    return F.when(F.contains(text, F.lit("\n\\")), F.regexp_replace(text, r"\n\\[^\n]*+", "")).otherwise(text)


def hunk_texts(files: Column) -> Column:
    """Hunks of a ``files_text`` without the mark they begin with, in order. Files and hunks are cut at plain texts, which are looked for by leaps."""
    cut = F.split(files, "\n" + _HUNK_MARK + "(?=[0-9])")
    return F.transform(F.slice(cut, 2, _EVERY), lambda h: F.substring_index(h, "\n" + _FILE_START, 1))


# The first number of a hunk's header, where the whole header is as it should be.
_STARTS = "\n" + _HUNK_MARK + r"(?=[0-9])((?:[0-9]+(?=(?:,[0-9]+)? \+[0-9]+(?:,[0-9]+)? @@))?)"


def hunk_starts(files: Column) -> Column:
    """First old lines of the hunks of a ``files_text``, in order; a missing one reads as 1."""
    return F.transform(F.regexp_extract_all(files, F.lit(_STARTS), F.lit(1)), lambda n: F.coalesce(
        none_if_empty(n).try_cast("bigint"), F.lit(1).cast("bigint")))


# A stretch of changed lines with the context before it. No quantifier gives back and a match begins where the one before ends, so a hunk is
# read once.
_STRETCH = r"\G[^\n]*+(?:\n(?![+\-])[^\n]*+)*+(?:\n[+\-][^\n]*+)++"
#: Stretches that are placed one after the other; longer lists are placed by pieces, whose sums come first.
_AT_ONCE = 128


def changes(hunk: Column) -> Column:
    """Array of (lines, added, removed) of a hunk without remarks: its stretches of changed lines in order, each with the context before it.
    Lines are counted by the signs they begin with; they are not unfolded."""
    def starting(text: Column, sign: str) -> Column:
        return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n" + sign), F.lit("\n" if sign else "")))

    return F.transform(F.regexp_extract_all(hunk, F.lit(_STRETCH), F.lit(0)), lambda s: F.struct(
        starting(s, "").alias("lines"), starting(s, "+").alias("added"), starting(s, "-").alias("removed")))


def changed_blocks(stretches: Column, old_start: Column) -> Column:
    """Array of (line_start, line_end, added, removed): maximal stretches of changed lines, as line ranges on the old side.

    ``stretches`` are those of ``changes``, as a plain column or a lambda's. A stretch that only inserts stands at the old line before it.
    """
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda at, s: at + (s["lines"] - s["added"]))

    def inside(part: Column, start: Column) -> Column:
        return F.transform(part, lambda s, i: F.struct(
            (start + total(F.slice(part, F.lit(1), i + 1)) - s["removed"]).alias("at"), s["added"].alias("added"), s["removed"].alias("removed")))

    def by_pieces(part: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.ceil(F.size(part) / _AT_ONCE).cast("int") - 1), lambda c: F.slice(part, c * _AT_ONCE + 1, _AT_ONCE))
        summed = F.transform(pieces, lambda p: F.struct(p.alias("part"), total(p).alias("lines"), F.lit(0).alias("added")))
        return F.flatten(F.flatten(F.transform(F.array(summed), lambda all_of: F.transform(all_of, lambda p, c: inside(
            p["part"], old_start + total(F.slice(all_of, F.lit(1), c)))))))

    placed = F.when(F.size(stretches) <= _AT_ONCE, inside(stretches, old_start)).otherwise(by_pieces(stretches))
    before = lambda c: F.greatest(c["at"] - 1, F.lit(0).cast("bigint"))
    return F.transform(placed, lambda c: F.struct(
        F.when(c["removed"] > 0, c["at"]).otherwise(before(c)).alias("line_start"),
        F.when(c["removed"] > 0, c["at"] + c["removed"] - 1).otherwise(before(c)).alias("line_end"),
        c["added"].cast("bigint").alias("added"), c["removed"].cast("bigint").alias("removed")))
