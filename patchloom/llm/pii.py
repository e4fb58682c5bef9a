"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Base kinds are decided by pattern and checksum alone and always stay: e-mail addresses, IPv4
addresses, payment cards (Luhn), international phone numbers. Added kinds start from a base
score of their pattern, gain from a checksum that holds (IBAN: mod 97) and from context words
close by, and count from ``threshold`` on. An added span that overlaps a base span, or an
earlier added span, is left out.

All of it is a pass over the rows: no shuffle, whole texts, offsets in code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.rows import with_text_columns
from patchloom.llm.words import let_go


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of an international bank account number: rearranged, letters as 10 to 35, the remainder is 1."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _ip(text: str) -> bool:
    parts = (p.lstrip("0") or "0" for p in text.split("."))
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


#: Base kinds in the order of the contract: pattern, confirmation, a character every match holds.
BASE: dict[str, tuple[re.Pattern, Callable[[str], bool], str]] = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda _: True, "@"),
    # A match can only start where a run of digits does; saying so keeps long runs linear.
    "ip": (re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), _ip, "."),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), _card, ""),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda x: 10 <= len(_digits(x)) <= 15, "+"),
}
_MAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL_REST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_HAS_DIGIT = re.compile("[0-9]")


# Characters of an account number by country, a line per length.
_IBAN_SIZES = {country: size for size, countries in {
    15: "NO",
    16: "BE",
    18: "DK FK FI FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}.items() for country in countries.split()}
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")
_ALNUM = re.compile("[A-Za-z0-9]")


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers whose checksum holds: as long as the country's are; of unknown countries, up to the last word's end that fits."""
    for m in _IBAN_HEAD.finditer(text):
        rest = _IBAN_REST.match(text, m.end())
        if rest is None:
            continue
        size, ends, n = _IBAN_SIZES.get(m[0][:2]), [], 4
        for at in range(m.end(), rest.end()):
            n += text[at] != " "
            if text[at] != " " and n >= 15 and size in (None, n) and not _ALNUM.match(text, at + 1):
                ends.append(at + 1)
        for e in reversed(ends):
            if mod97(text[m.start(): e].replace(" ", "")):
                yield m.start(), e
                break


def _matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text))


@dataclass(frozen=True)
class Added:
    """A kind found by score: what a candidate alone is worth, what a checksum or a word nearby adds."""

    candidates: Callable[[str], Iterator[tuple[int, int]]]
    base: float
    check: Callable[[str], bool] | None
    words: frozenset[str]


ADDED: dict[str, Added] = {
    "iban": Added(_ibans, 0.2,
                  lambda x: mod97(x.replace(" ", "")), frozenset({"iban", "bank", "account", "konto", "compte", "cuenta", "bic"})),
    "ssn": Added(_matches(re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")), 0.4,
                 None, frozenset({"ssn", "social", "security", "taxpayer"})),
    "secret": Added(_matches(re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|[A-Za-z0-9_]{2,6}_[A-Za-z0-9]{30,64})(?![A-Za-z0-9])")), 0.4,
                    None, frozenset({"token", "secret", "password", "passwd", "key", "apikey", "api_key", "credential", "bearer"})),
}
_WORD = re.compile(r"[^\W\d_]+(?:_[^\W\d_]+)*")
CHECKED, NEARBY, WINDOW = 0.6, 0.4, 40


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the e-mail pattern. The local part is run back from each @, since trying the pattern at every
    character of a long run takes time with its square."""
    out, least = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > least and text[start - 1] in _MAIL_LOCAL:
            start -= 1
        m = _MAIL_REST.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            least = m.end()
            at = text.find("@", least)
        else:
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by start, then kind as listed."""
    found: list[tuple[int, int, str, int]] = []
    numbers = _HAS_DIGIT.search(text) is not None
    for order, (kind, (pattern, confirmed, mark)) in enumerate(BASE.items()):
        if kind == "email":
            found += [(s, order, kind, e) for s, e in _emails(text)]
        elif numbers and mark in text:
            found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text) if confirmed(m[0])]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def _union(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that some spans cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in sorted((s, e) for _, s, e in spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def added_spans(text: str, taken: list[tuple[str, int, int]], threshold: float) -> list[tuple[str, int, int]]:
    """Spans of the added kinds that reach the threshold and overlap nothing taken."""
    if _HAS_DIGIT.search(text) is None:
        return []
    found: list[tuple[str, int, int]] = []
    for kind, rule in ADDED.items():
        starts, ends = _union(taken + found)
        last = 0
        for s, e in rule.candidates(text):
            at = bisect_right(starts, s)
            if s < last or at and ends[at - 1] > s or at < len(starts) and starts[at] < e:
                continue
            score = rule.base
            if rule.check is not None:
                score += CHECKED if rule.check(text[s:e]) else -CHECKED
            near = text[max(0, s - WINDOW): s] + " " + text[e: e + WINDOW]
            if any(w in rule.words for w in _WORD.findall(near.lower())):
                score += NEARBY
            if score >= threshold:
                found.append((kind, s, e))
                last = e
    return found


def _order(span: tuple[str, int, int]) -> tuple:
    kinds = [*BASE, *ADDED]
    return span[1], kinds.index(span[0])



_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def _masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, s, e in spans:
        if e <= at:
            continue
        out += [text[at: max(s, at)], f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def personal_data(df: DataFrame, keep: list[str], text: str = "text", threshold: float = 0.7, mask: bool = False) -> DataFrame:
    """Every row's kept columns as ``row`` and its ``base`` spans and all ``spans`` (kind, start, end; code points, end exclusive);
    with ``mask``, also the ``masked`` text, each span replaced by its kind in brackets (of one that overlaps another, the rest).

    A null or empty text has no spans (masked: null stays null). A text is searched whole, however long. Of candidates that overlap, base kinds
    come first, then added kinds as listed, then the one that starts first. Repeated rows give repeated results, an empty table an empty one.
    """
    fields = [T.StructField("base", T.ArrayType(_SPAN)), T.StructField("spans", T.ArrayType(_SPAN))]
    if mask:
        fields.append(T.StructField("masked", T.StringType()))

    def make():
        let_go()

        def work(texts: pa.Array) -> list:
            base, spans, masked = [], [], []
            for t in texts.to_pylist():
                own = base_spans(t or "")
                every = sorted(own + added_spans(t or "", own, threshold), key=_order)
                base.append([dict(zip(("kind", "start", "end"), x)) for x in own])
                spans.append([dict(zip(("kind", "start", "end"), x)) for x in every])
                if mask:
                    masked.append(t if t is None or not every else _masked(t, every))
            return [base, spans, masked] if mask else [base, spans]

        return work

    return with_text_columns(df, text, keep, fields, make)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""

    def line(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("row.*", *[count(k) for k in BASE], F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))


def masked_documents(df: DataFrame, text: str = "text", length: str | None = "n_chars", **settings) -> DataFrame:
    """The rows with personal data masked in ``text``; ``length``, where it is a column, is set to the new number of
    code points in rows whose text changed."""
    if text not in df.columns:  # a name that Spark resolves in another case
        text = next((c for c in df.columns if c.lower() == text.lower()), text)
    found = personal_data(df, [c for c in df.columns if c != text], text, mask=True, **settings)
    changed = F.size("spans") > 0

    def column(name):
        if name == text:
            return F.col("masked")
        kept = F.col("row")[name]
        return F.when(changed, F.length("masked")).otherwise(kept).cast(df.schema[name].dataType) if name == length else kept

    return found.select(*[column(c).alias(c) for c in df.columns])
