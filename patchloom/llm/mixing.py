"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words: shares by weight of a budget, held at ``limit`` times the source's words, the excess
shared again by weight among the rest. A document's expected number of copies is its source's target over its source's words, times
its own preference, at most ``limit``. The whole part of it is allocated to every document for certain; the fractional part p is an
inclusion probability, and documents are ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), with u drawn by id.
The first ones in that order are taken, up to the words still missing from the target: a sample of fixed size, in words,
with unequal probabilities.

Ranks and running words come from a range-partitioned order over narrow rows, so a source that holds a third of all rows
is spread over many tasks. Sources are a table too, never a list on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm.rows import col
from patchloom.llm.running import running_totals
from patchloom.session import materialised

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = 1.5, limit: int = 2) -> DataFrame:
    """``number`` (from 1, by code point, null last), ``source``, ``source_size``, ``target`` and ``certain`` (is the target the limit)
    of every source of ``sizes`` (columns ``source``, ``size``).

    One narrow row per source. A round of sharing is one aggregate; the set of limited sources only grows, and each round adds to it, so rounds are few.
    """
    by_source = materialised(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("group", F.lit(0)).withColumn("one", F.lit(1).cast("long")), "sources")
    order = [F.col("source").asc_nulls_last()]
    numbered = materialised(running_totals(by_source, "group", order, "one", "before").select(
        (F.col("before") + 1).alias("number"), "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("before") % len(weights) + 1).cast("int")).alias("weight"),
    ), "numbered")
    whole = numbered.agg(F.sum("source_size")).first()[0] or 0
    limited, level = 0, 0.0
    while True:
        at_limit = F.col("weight") * level > limit * F.col("source_size") if level else F.col("source_size") == 0
        sums = numbered.agg(
            F.sum(F.when(at_limit, 1)).alias("n"), F.sum(F.when(at_limit, limit * F.col("source_size"))).alias("words"),
            F.sum(F.when(~at_limit, F.col("weight"))).alias("weights")).first()
        if not sums.weights or level and (sums.n or 0) == limited:
            break
        limited, level = sums.n or 0, (budget * whole - (sums.words or 0)) / sums.weights
    target = F.least(F.col("weight") * F.lit(level), (limit * F.col("source_size")).cast("double"))
    return numbered.select("number", "source", "source_size", target.alias("target"))


def drawn_odds(doc_id: Column, p: Column, seed: int = 42) -> Column:
    """Random odds over inclusion odds; the random number in (0, 1) is drawn by id (a null id draws like an empty one)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return (u / (1 - u)) / (p / (1 - p))


def _copies(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with ``copies``: expected copies, ``limit`` at most, so that copies times size add up to each source's target.

    Documents whose preference asks for more than the limit stay at it, and the rest of their source is scaled up again, as sources are.
    """
    if rows.filter(F.col("preference") != 1).isEmpty():
        return rows.withColumn("copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    scaled = rows.withColumn("scale", F.lit(0.0))
    while True:
        over = F.col("preference") * F.col("scale") >= limit
        sums = scaled.groupBy("number").agg(
            F.sum(F.when(over, limit * F.col("size")).otherwise(0)).alias("held"),
            F.sum(F.when(over, 0.0).otherwise(F.col("preference") * F.col("size"))).alias("free"))
        new = F.when(F.col("free") > 0, (F.col("target") - F.col("held")) / F.col("free")).otherwise(F.col("scale"))
        after = materialised(scaled.join(sums, "number").withColumn("new", F.greatest(new, "scale")).drop("held", "free"), "copies")
        moved = after.filter(F.col("new") > F.col("scale") * (1 + 1e-12)).select("number").distinct()
        done = moved.isEmpty()
        scaled = after.drop("scale").withColumnRenamed("new", "scale")
        if done:
            return scaled.withColumn("copies", F.least(F.lit(float(limit)), F.col("preference") * F.col("scale")))


def mixed(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", preference: Column | None = None,
    weights: tuple = WEIGHTS, budget: float = 1.5, limit: int = 2, seed: int = 42,
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` (expected) and ``taken`` (words, repeats counted) of every row.

    ``preference`` (1 by default, positive) says how much likelier a document is to be taken than the others of its source.
    Sizes are words; a null, empty or wordless text has size 0 and takes 0. A null source is a source of its own, the last one.
    Each source's taken words miss its target by half a document at most, the one at the edge of the sample, as long as the target can be met by
    ``limit`` copies. Draws depend on id and seed alone, so reruns agree; rows that repeat an id share its draw and follow one another. An
    empty table gives an empty table. Other columns, whatever their names, are not read.
    """
    preference = F.lit(1.0) if preference is None else preference.cast("double")
    sized = materialised(documents.select(
        col(doc_id).alias("doc_id"), col(source).cast("string").alias("source"), preference.alias("preference"),
        F.coalesce(F.regexp_count(col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ), "sized")
    targets = source_targets(sized, weights, budget, limit)
    rows = sized.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "doc_id", "d.source", "size", "preference", "number", "source_size", "target")
    rows = _copies(rows, limit)
    whole = F.floor("copies")
    p = F.col("copies") - whole
    rows = materialised(rows.withColumn("whole", whole).withColumn(
        "odds", F.when(p > 0, drawn_odds(F.col("doc_id"), p, seed)).otherwise(F.lit(float("inf")))), "odds")
    certain = rows.groupBy("number").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    order = [F.col("odds").asc(), F.col("doc_id").asc_nulls_last(), F.col("size").asc()]
    ranked = running_totals(rows, "number", order, "size", "before").join(certain, "number")
    middle = F.col("before") + F.col("size") / 2
    more = (F.col("odds") < float("inf")) & (middle < F.col("target") - F.col("certain"))
    return ranked.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * (F.col("whole") + F.when(more, 1).otherwise(0))).cast("long").alias("taken"))
