"""Quality rules under weak supervision.

Measures of a text are counted once. Two hard limits (``base_failed``) reject on their own. Beyond
them, rules over the measures vote good or bad or abstain; expectation-maximisation over the vote
patterns of all rows estimates how far each rule can be trusted, and a row is kept where its
posterior probability of being good reaches ``least``: one doubtful rule no longer rejects a text.

Measuring is a pass over the rows. The only shuffle is of at most 3 ** rules pattern counts.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.label_model import LabelModel, fitted, pattern_counts
from patchloom.llm.rows import with_text_columns
from patchloom.session import materialised

SYMBOLS = "#*$%&|<>"
WINDOW = 8
_SPACE = " \t\n\v\f\r"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marked", "n_capitals", "n_exclaimed"]


def _repeated(words: list[bytes]) -> int:
    """Words inside windows that occur twice or more in the text."""
    if len(words) < WINDOW + 1:
        return 0
    joined = b" ".join(words)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    starts.append(at)
    windows = [joined[s: e - 1] for s, e in zip(starts, starts[WINDOW:])]
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total = end = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + WINDOW - max(i, end)
            end = i + WINDOW
    return total


def measures(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``; null is empty."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # splits at ASCII white space only
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "surrogatepass")),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        sum(w.endswith((b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")) for w in words),
        sum(w.isupper() and len(w) > 1 for w in words),
        text.count("!"),
    )


def vote(bad: F.Column | None = None, good: F.Column | None = None) -> F.Column:
    """1 where ``good`` holds or 0 where ``bad`` does; null, an abstention, elsewhere and for texts without words."""
    empty = F.when(F.col("n_words") == 0, None)
    return empty.when(bad, 0) if good is None else empty.when(good, 1)


def rules() -> dict[str, F.Column]:
    """Votes over the measures. Most rules look for one fault and abstain without it; two vouch for texts with few signs and
    capitals, or with little repeated."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    symbols, marked = F.col("n_symbols") / n, F.col("n_marked") / n
    shouted, capitals = F.col("n_exclaimed") / n, F.col("n_capitals") / n
    repeats, lines = F.col("n_repeat_words") / n, F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    mean = F.col("word_chars") / n
    return {
        "symbols": vote(bad=symbols > 0.1),
        "marked_words": vote(bad=marked > 0.2),
        "exclamation": vote(bad=shouted > 0.1),
        "capitals": vote(bad=capitals > 0.3),
        "repeats": vote(bad=repeats > 0.2),
        "repeated_lines": vote(bad=lines > 0.3),
        "odd_words": vote(bad=(mean < 3) | (mean > 12)),
        "plain_prose": vote(good=(symbols < 0.02) & (capitals < 0.05)),
        "varied_prose": vote(good=(repeats < 0.05) & (shouted < 0.02)),
    }


def measured(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns as ``row`` and the measures of every row."""

    def work(texts: pa.Array) -> list:
        return [pa.array(x, pa.int64()) for x in zip(*map(measures, texts.to_pylist()))]

    return with_text_columns(df, text, keep, [T.StructField(m, T.LongType()) for m in MEASURES], lambda: work)


def base_failed() -> F.Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(df: DataFrame, keep: list[str], text: str = "text", least: float = 0.5) -> tuple[DataFrame, LabelModel]:
    """Measures, ``base_failed``, ``p_good`` (posterior) and ``kept`` of every row, and the fitted model.

    The model is fitted on the rows that pass the base limits; what fails them is not kept whatever the votes.
    Null and empty texts have no words and fail. An empty table gives no rows and a model at its starting point.
    """
    table = materialised(measured(df, keep, text), "measures")
    votes = rules()
    passed = table.withColumns({"base_failed": base_failed()})
    patterns, counts = pattern_counts(passed.filter(~F.col("base_failed")).select(*[v.alias(r) for r, v in votes.items()]), list(votes))
    model = fitted(patterns, counts, list(votes))
    out = passed.withColumn("p_good", model.posterior(list(votes.values())))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least)), model
