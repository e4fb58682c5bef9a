"""Model answers: fences, JSON shapes and truth values.

Answers are parsed as variants, so one odd value never fails a row; the shape
decides what becomes of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom import fixed
from patchloom.functions.text import WS, strip

_JSON_BLOCK = rf"(?is)```json[{WS}]*(.*?)[{WS}]*```"
_ANY_BLOCK = rf"(?s)```[{WS}]*(.*?)[{WS}]*```"
_WHOLE_BLOCK = rf"(?is)\A```(?:json)?[{WS}]*\n(.*?)\n```\z"


def fenced_block(text: Column) -> Column:
    """The first fenced block anywhere, a json-tagged one first; else the text itself. Stripped."""
    t = strip(text)
    return (
        F.when(t.rlike(_JSON_BLOCK), strip(F.regexp_extract(t, _JSON_BLOCK, 1)))
        .when(t.rlike(_ANY_BLOCK), strip(F.regexp_extract(t, _ANY_BLOCK, 1)))
        .otherwise(t)
    )


def unfenced(text: Column) -> Column:
    """The inside of a text that is one fenced block as a whole; else the text itself. Stripped."""
    t = strip(text)
    return F.when(t.rlike(_WHOLE_BLOCK), strip(F.regexp_extract(t, _WHOLE_BLOCK, 1))).otherwise(t)


def parsed(text: Column) -> Column:
    """The text as a variant; null when it is not JSON."""
    return F.try_parse_json(text)


def at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def shape(value: Column) -> Column:
    """Type of a variant as text: OBJECT<...>, ARRAY<...>, STRING, BIGINT, VOID ..."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(shape(value).startswith("OBJECT"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(shape(value).startswith("ARRAY"), F.lit(False))


def is_string(value: Column) -> Column:
    return F.coalesce(shape(value) == "STRING", F.lit(False))


def is_whole_number(value: Column) -> Column:
    # JSON integers past bigint come out as decimals without fraction digits.
    return F.coalesce(shape(value).rlike(r"\A(?:BIGINT|DECIMAL\([0-9]+,0\))\z"), F.lit(False))


def _when_string(value: Column) -> Column:
    """The text of a variant that is a string; null for any other kind."""
    # A one-element array binds the value: it is looked up once, not once per use.
    return F.try_variant_get(F.get(F.filter(F.array(value), is_string), 0), "$", "string")


def string_at(value: Column, path: str) -> Column:
    """A member that is a string; null for any other kind."""
    return _when_string(at(value, path))


def items(value: Column, path: str = "$") -> Column:
    """Elements of an array; an empty array for any other kind."""
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.array().cast("array<variant>"))


def array_at(value: Column, path: str = "$") -> Column:
    """Elements of an array; null for any other kind. Tells whether a member is an array without going through what it holds."""
    return F.try_variant_get(value, path, "array<variant>")


def plain_text(value: Column) -> Column:
    """A string as it is, any other value as JSON text, null as null."""
    return F.when(is_string(value), F.try_variant_get(value, "$", "string")).when(
        ~F.is_variant_null(value), F.to_json(value)
    )


def truthy(value: Column) -> Column:
    """Whether a value counts as true: everything but null, false, zero and the empty ones.

    The text ``"false"`` therefore counts as true.
    """

    def counts(v: Column) -> Column:
        empty = F.to_json(v).isin("null", "false", '""', "[]", "{}")
        zero = shape(v).rlike(r"\A(?:BIGINT|DOUBLE|FLOAT|DECIMAL.*)\z") & (F.try_variant_get(v, "$", "double") == 0.0)
        return F.coalesce(~empty & ~F.coalesce(zero, F.lit(False)), F.lit(False))

    return F.exists(F.array(value), counts)


def issue_numbers(value: Column) -> Column:
    """Issue numbers of a parsed answer, as text, distinct, in order.

    The answer is an object with an ``issues`` array or a bare array. Digit
    strings and positive whole numbers count, all else is passed over. Null for
    an answer of another shape.
    """
    listed = F.when(is_object(value), items(value, "$.issues")).when(is_array(value), items(value))
    texts = F.transform(
        listed,
        lambda v: F.when(is_string(v), strip(F.try_variant_get(v, "$", "string"))).when(
            is_whole_number(v), F.to_json(v)
        ),
    )
    kept = F.filter(texts, lambda t: F.coalesce(t.rlike(r"\A0*[1-9][0-9]*\z"), F.lit(False)))
    return F.array_distinct(kept)


def selected_paths(value: Column) -> Column:
    """Text elements of ``selected_doc_paths``, in order; empty when it is no array."""
    strings = F.filter(items(value, "$.selected_doc_paths"), is_string)
    return F.transform(strings, lambda v: F.try_variant_get(v, "$", "string"))


def selection_reason(value: Column) -> Column:
    member = at(value, "$.reason")
    return F.when(member.isNull(), F.lit("")).otherwise(plain_text(member))


def valid_paths(selected: Column, available: Column) -> Column:
    """Selected paths that exist, each once, in the order of selection."""
    none = F.array().cast("array<string>")
    return F.array_intersect(F.coalesce(selected, none), F.coalesce(available, none))


def review_is_readable(value: Column) -> Column:
    """An object whose ``checks`` is an object, absent or empty."""
    checks = at(value, "$.checks")
    return is_object(value) & (is_object(checks) | ~truthy(checks))


def review_checks(value: Column) -> Column:
    return F.struct(*[truthy(at(value, f"$.checks.{name}")).alias(name) for name in fixed.REVIEW_CHECKS])


def review_reasoning(value: Column) -> Column:
    return F.coalesce(plain_text(at(value, "$.reasoning")), F.lit(""))
