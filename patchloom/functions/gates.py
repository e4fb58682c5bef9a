"""Word checks on generated specs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom import fixed

_NORMATIVE = r"(?i)\b(?:" + "|".join(fixed.NORMATIVE_WORDS) + r")\b"
_BANNED = r"(?i)\b(?:" + "|".join(fixed.BANNED_WORDS) + r")\b"
_IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_$]*"

# Words of the hardware language itself, which leak nothing when they recur in prose.
LANGUAGE_WORDS = [
    "always", "always_comb", "always_ff", "always_latch", "and", "assign", "begin", "bit", "case", "default",
    "else", "end", "endcase", "endfunction", "endmodule", "endtask", "enum", "for", "function", "generate",
    "genvar", "if", "initial", "inout", "input", "int", "integer", "localparam", "logic", "module", "negedge",
    "not", "or", "output", "package", "parameter", "posedge", "reg", "return", "signed", "struct", "task",
    "typedef", "unsigned", "wire", "xor",
]


def uses_normative_words(spec: Column) -> Column:
    return spec.rlike(_NORMATIVE)


def banned_word_count(spec: Column) -> Column:
    return F.regexp_count(spec, F.lit(_BANNED)).cast("bigint")


def identifiers(text: Column) -> Column:
    """Distinct identifiers of a text, language words left out."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(_IDENTIFIER), F.lit(0)))
    return F.array_except(found, F.array(*[F.lit(w) for w in LANGUAGE_WORDS]))
