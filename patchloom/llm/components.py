"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.session import materialised

#: A node with more than one in so many of all edge ends is joined apart; there are fewer such nodes than this.
CROWD = 1000


def _with_least(edges: DataFrame, least: DataFrame, crowd: int) -> DataFrame:
    """``edges`` with ``m`` of their node ``a``. ``least`` holds one row per node (``a``, ``m``, and ``n``, its number of edge ends).

    Of the ends, nodes with more than one in ``crowd`` are fewer than ``crowd`` whatever the graph; these rows go to all tasks, and the edges
    of such a node stay where they are. All others meet by shuffle, where no key holds more than that share.
    """
    most = (least.agg(F.sum("n")).first()[0] or 0) / crowd
    crowded = F.broadcast(least.filter(F.col("n") > most).select("a", "m"))
    rest = edges.join(crowded.select("a"), "a", "left_anti").join(least.filter(F.col("n") <= most).select("a", "m"), "a")
    return edges.join(crowded, "a").select("a", "b", "m").unionAll(rest.select("a", "b", "m"))


def components(edges: DataFrame, rounds: int = 64, crowd: int = CROWD) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) for every node of ``edges`` (columns ``a``, ``b``; any comparable type).

    Alternating star rounds: each node hangs its larger neighbours, then its smaller ones, under the least node it sees;
    the number of rounds grows with the logarithm of the longest path. Every round takes minima per node (combined before
    the shuffle) and joins them to the edges; nodes with very many neighbours, such as the root of a large component, are joined apart and
    never gathered. What a round makes is written to the shared folder, which cuts lineage.
    Self-loops, repeated and null edges are left out; an empty table gives an empty table.
    """
    edges = edges.select("a", "b").filter("a <> b").distinct()
    edges = materialised(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialised(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n")), "least")
        # large star: larger neighbours go under the least one seen
        large = materialised(
            _with_least(both.filter("b > a"), least, crowd).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = materialised(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
        # small star: smaller neighbours, and the node itself, go under the least of them
        small = _with_least(large, least, crowd).select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        after = materialised(small.select("e.*").filter("a <> b").distinct(), "edges")
        marks = [F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.count_distinct("a")]
        was, now = edges.agg(*marks).first(), after.agg(*marks).first()
        edges = after
        if tuple(was) == tuple(now) and now[0] == now[2]:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
