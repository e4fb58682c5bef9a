"""Document titles and the texts built from documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom import fixed
from patchloom.functions.paths import stem, suffix
from patchloom.functions.text import NL, SP, WS, lines, none_if_empty, strip

_MD_HEADING = rf"(?:\A|[{NL}])[{SP}]*#[{SP}]+([^{WS}][^{NL}]*)"
_RST_DIRECTIVE = rf"(?i)(?:\A|[{NL}])[{SP}]*\.\.[{SP}]*title::[{SP}]*([^{WS}][^{NL}]*)"
_RST_UNDERLINE = r"\A(?:" + "|".join(rf"\{c}+" for c in fixed.RST_UNDERLINES) + r")\z"


def md_title(content: Column) -> Column:
    """Text of the first line that reads ``# title``; null for none."""
    return none_if_empty(strip(F.regexp_extract(content, _MD_HEADING, 1)))


def rst_title(content: Column) -> Column:
    """A title directive anywhere, else the first line with an underline at least as long; null for none."""
    directive = none_if_empty(strip(F.regexp_extract(content, _RST_DIRECTIVE, 1)))
    rows = F.transform(lines(content), strip)
    pairs = F.zip_with(rows, F.slice(rows, 2, F.size(rows)), lambda a, b: F.struct(a.alias("text"), b.alias("below")))
    headings = F.filter(
        pairs,
        lambda p: (p["text"] != "")
        & F.coalesce(p["below"].rlike(_RST_UNDERLINE), F.lit(False))
        & (F.length(p["below"]) >= F.length(p["text"])),
    )
    return F.coalesce(directive, F.try_element_at(headings, F.lit(1))["text"])


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest (ASCII words)."""
    # A marked gap between a digit and a letter makes the letter start a word of its own.
    gap = " \x01 "
    return F.replace(F.initcap(F.regexp_replace(text, "(?<=[0-9])(?=[A-Za-z])", gap)), F.lit(gap), F.lit(""))


def name_title(path: Column) -> Column:
    """A readable title made of the file name."""
    words = F.trim(F.regexp_replace(stem(path), "[^a-zA-Z0-9]+", " "))
    return F.coalesce(none_if_empty(title_case(words)), stem(path))


def doc_title(path: Column, content: Column) -> Column:
    """Title of a document by its kind, else one made of its name."""
    end = suffix(path)
    own = F.when(end == ".md", md_title(content)).when(end == ".rst", rst_title(content))
    return F.coalesce(own, name_title(path))


def format_doc_toc(doc_toc: Column) -> Column:
    """One ``- path: title`` line per document; a fixed sentence for none."""
    rows = F.transform(
        doc_toc,
        lambda e: F.concat(
            F.lit("- "), F.coalesce(e["path"], F.lit("")), F.lit(": "), F.coalesce(e["title"], F.lit(""))
        ),
    )
    none = F.coalesce(F.size(doc_toc), F.lit(0)) <= 0
    return F.when(none, fixed.EMPTY_TOC).otherwise(F.array_join(rows, "\n"))


def doc_block(path: Column, text: Column) -> Column:
    """One selected document as it stands in a prompt."""
    return F.concat(F.lit("### "), path, F.lit("\n\n"), F.coalesce(text, F.lit("")))
