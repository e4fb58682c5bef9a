"""Issue references in pull request text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom import fixed
from patchloom.functions.text import WORD, WS, or_empty

# "<word> #<number>". A match starts at a word's first letter or right after the
# previous match, and no quantifier gives back: linear even on very long words.
_WORD_NUMBER = rf"(?:(?<![{WORD}])|\G)[{WORD}]++[{WS}]++#[0-9]++"
_CLOSING = r"\A(?:" + "|".join(fixed.CLOSING_KEYWORDS) + rf")[{WS}]"
_URL = rf"github\.com/[^/{WS}]+/[^/{WS}]+/issues/[0-9]+"
_COMMENT = r"(?s)<!--.*?-->"


def pr_text(title: Column, body: Column, messages: Column) -> Column:
    """Title, body and commit messages, one after the other; nulls read as empty."""
    return F.concat_ws("\n", or_empty(title), or_empty(body), or_empty(F.array_join(messages, "\n", "")))


def strip_html_comments(text: Column) -> Column:
    """Drop closed comments, also across lines; an unclosed one stays."""
    return F.regexp_replace(text, _COMMENT, "")


def _numbers(matches: Column) -> Column:
    numbers = F.transform(matches, lambda m: F.regexp_extract(m, r"[0-9]+\z", 0).try_cast("bigint"))
    return F.filter(numbers, lambda n: n > 0)


def keyword_issue_refs(text: Column) -> Column:
    """Numbers that follow a closing keyword, in order of appearance."""
    matches = F.regexp_extract_all(text, F.lit(_WORD_NUMBER), F.lit(0))
    return _numbers(F.filter(matches, lambda m: F.lower(m).rlike(_CLOSING)))


def url_issue_refs(text: Column, org: Column | None = None, repo: Column | None = None) -> Column:
    """Numbers in issue addresses, in order of appearance.

    An address of any repository counts. Given ``org`` and ``repo``, only
    addresses of that repository do.
    """
    matches = F.regexp_extract_all(text, F.lit(_URL), F.lit(0))
    if org is not None and repo is not None:
        own = F.lower(F.concat(F.lit("github.com/"), org, F.lit("/"), repo, F.lit("/issues/")))
        matches = F.filter(matches, lambda m: F.lower(m).startswith(own))
    return _numbers(matches)


def ref_union(text: Column, org: Column | None = None, repo: Column | None = None) -> Column:
    """All referenced issue numbers of a comment-free text: distinct, ascending."""
    return F.array_sort(F.array_union(keyword_issue_refs(text), url_issue_refs(text, org, repo)))
