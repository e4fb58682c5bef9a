"""Line and whitespace rules shared by the text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: all characters that count as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Line-ending characters and all blanks, as the inside of a regex character class.
NL = r"\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}"
WS = r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Blanks that stay within a line.
SP = r"\t\x1f \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
# A letter, digit or underscore in any script.
WORD = r"\p{L}\p{N}_"


def strip(text: Column) -> Column:
    """Drop blanks at both ends."""
    return F.trim(text, F.lit(BLANKS))


def lines(text: Column) -> Column:
    """Split into lines at any line break; CR LF is one break."""
    return F.split(text, rf"\r\n|[{NL}]")


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def iso_utc(moment: Column) -> Column:
    """A timestamp as ISO text in UTC, whatever the session's zone is."""
    utc = F.convert_timezone(None, F.lit("UTC"), moment.cast("timestamp_ntz"))
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def once(name: str, value: Column) -> Column:
    """A costly value, worked out once per row, for ``select("*", once(...))``.

    A filter on a plain column is moved below the projection and works the value
    out a second time; it cannot move below this one-row generator.
    """
    return F.inline(F.array(F.struct(value.alias(name))))
