"""Hard negatives by anchor-clustered shared lists.

Score of two rows: the inner product of their vectors, scaled and rounded down to whole numbers. Anchors are clustered by
direction. A candidate at angle phi from a cluster's centre has a score of at most norm(anchor) * norm(candidate) * cos(max(0, phi - spread))
with any member, spread being the widest angle of a member to the centre. Candidates are sorted by that bound once for a cluster, and every
member walks that one list, a block of candidates at a time, until the bound of what is left is below what it still
needs: then its result is certified, and the rest of the list is never scored.

First the positives are walked for (the best rows of the anchor's label), then the negatives: the best rows of other labels
inside a band below each positive's score.

Spread over Spark: rows are cut into shards of bounded size by a hash, anchors go to every shard (they are the few), and each shard has the
lists of its own candidates. A task holds one shard and walks the anchors as they come, cluster by cluster. A shard hands on its best few for an
anchor, and the best few of all shards are kept. Many anchors are dealt out in blocks as well, so no task grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.llm.rows import col
from patchloom.session import materialised

#: Candidates that a member scores before it looks at the bound again, and members that walk side by side.
STRIDE, MEMBERS = 2048, 512
#: Bytes of vectors of one shard, and the fewest rows it is made for.
SHARD_BYTES, SHARD_ROWS = 16 << 20, 2048
#: Anchors that meet a shard in one task.
ANCHORS = 1 << 15
#: Anchors that the centres are fitted on, anchors wanted in a cluster, and the most clusters.
SAMPLE, CLUSTER, CLUSTERS = 4096, 256, 64
#: Vectors this long (after scaling) may have scores whose hundredfold does not fit a long.
_LONGEST = float(1 << 28)
_NONE = np.iinfo(np.int64).min


def prepared(rows: DataFrame, scale: int) -> DataFrame:
    """Rows (``vec_id``, ``label``, ``vector``, ``anchor``) that take part, with a number (``row``), ``v`` (scaled whole numbers, as doubles) and ``norm``."""
    x = F.transform("vector", lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(e * scale).cast("double"))
    used = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(finite).select("vec_id", "label", "anchor", v.alias("v"))
    used = used.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e)))
    return used.filter(F.col("norm") < _LONGEST).withColumn("row", F.monotonically_increasing_id())


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of doubles as rows; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _units(v: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return v / np.where(norm > 0, norm, 1)[:, None]


def centres(v: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` or fewer unit vectors, by spherical k-means from evenly spaced rows."""
    units = _units(v, np.linalg.norm(v, axis=1))
    c = units[np.linspace(0, len(units) - 1, k).astype(int)]
    for _ in range(rounds):
        at = np.argmax(units @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, units)
        size = np.linalg.norm(sums, axis=1)
        c = np.where((size > 0)[:, None], sums / np.where(size > 0, size, 1)[:, None], c)
    return c


def _scores(a: np.ndarray, b: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products as whole numbers, in the narrowest arithmetic that holds products up to ``top``."""
    if top < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if top < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class _Best:
    """The best few candidates of each member and each of its wishes: scores downwards, ties by the smaller id (null last)."""

    def __init__(self, members: int, wishes: int, most: int):
        self.score = np.full((members, wishes, most), _NONE)
        self.at = np.full((members, wishes, most), -1)
        self.most = most

    def add(self, member: np.ndarray, wish: int, score: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
        """Candidates ``at`` (places in the shard, ``rank`` is their order by id) with their scores."""
        if not len(member):
            return
        who = np.unique(member)
        old_at, old_score = self.at[who, wish], self.score[who, wish]
        held = old_at >= 0
        m = np.concatenate([member, np.repeat(who, held.sum(axis=1))])
        s, c = np.concatenate([score, old_score[held]]), np.concatenate([at, old_at[held]])
        order = np.lexsort((rank[c], -s, m))
        m, s, c = m[order], s[order], c[order]
        first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        place = np.arange(len(m)) - np.repeat(first, np.diff(np.r_[first, len(m)]))
        top = place < self.most
        self.at[who, wish], self.score[who, wish] = -1, _NONE
        self.at[m[top], wish, place[top]], self.score[m[top], wish, place[top]] = c[top], s[top]

    def least(self) -> np.ndarray:
        """The score that a candidate must reach to count (members by wishes)."""
        return self.score[:, :, -1]


class Shard:
    """Some candidates, and for one cluster at a time their list by bound."""

    def __init__(self, rows: np.ndarray, ids: pa.Array, labels: np.ndarray, v: np.ndarray, norm: np.ndarray):
        self.rows, self.ids, self.labels, self.v, self.norm = rows, ids, labels, v, norm
        null = ids.is_null().to_numpy(zero_copy_only=False)
        self.rank = np.empty(len(ids), dtype=np.int64)
        self.rank[np.lexsort((rows, ids.fill_null(0).to_numpy(), null))] = np.arange(len(ids))

    def list_of(self, v: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidates by falling bound on the score with any of some anchors of length 1, and the bounds."""
        width = max(v.shape[1], self.v.shape[1])
        units = _wide(_units(v, norm), width)
        centre = units.sum(axis=0)
        size = np.linalg.norm(centre)
        if size == 0:
            bound = self.norm.copy()
        else:
            centre /= size
            spread = np.arccos(np.clip(units @ centre, -1, 1)).max() + 1e-6
            cosine = _wide(self.v, width) @ centre / np.where(self.norm > 0, self.norm, 1)
            angle = np.maximum(np.arccos(np.clip(cosine, -1, 1)) - spread - 1e-6, 0)
            bound = self.norm * np.cos(angle)
        bound = bound + 1e-9 * np.abs(bound) + 1e-6
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]

    def walk(self, v: np.ndarray, norm: np.ndarray, needs: Callable[[], np.ndarray], meet: Callable) -> None:
        """Members of one cluster walk the list. ``needs()`` tells the least score each can still use; ``meet`` gets members, candidates and scores."""
        order, bound = self.list_of(v, norm)
        width = max(v.shape[1], self.v.shape[1])
        v, top = _wide(v, width), float(norm.max(initial=0) * self.norm.max(initial=0)) * (1 + 1e-9) + 1
        going = np.arange(len(v))
        for i in range(0, len(order), STRIDE):
            going = going[norm[going] * bound[i] * (1 + 1e-9) + 1e-3 >= needs()[going]]
            if not len(going):
                return
            at = order[i: i + STRIDE]
            for j in range(0, len(going), MEMBERS):
                part = going[j: j + MEMBERS]
                meet(part, at, _scores(v[part], _wide(self.v[at], width), top))


def _positives(shard: Shard, anchors: dict, most: int) -> list[tuple]:
    """(member, candidate, score) of the best other rows of each anchor's label."""
    best = _Best(len(anchors["row"]), 1, most)

    def meet(part, at, scores):
        fits = (shard.labels[at][None, :] == anchors["label"][part][:, None]) & (shard.rows[at][None, :] != anchors["row"][part][:, None])
        least = best.least()[part, 0]
        if at.shape[0] > most:
            shown = np.where(fits, scores, _NONE)
            least = np.maximum(least, np.partition(shown, -most, axis=1)[:, -most])
        m, c = np.nonzero(fits & (scores >= least[:, None]))
        best.add(part[m], 0, scores[m, c], at[c], shard.rank)

    shard.walk(anchors["v"], anchors["norm"], lambda: best.least()[:, 0], meet)
    m, _, k = np.nonzero(best.at >= 0)
    return [m, best.at[m, 0, k], best.score[m, 0, k]]


def _negatives(shard: Shard, anchors: dict, most: int, low: int, high: int) -> list[tuple]:
    """(member, candidate, score) of the best rows of other labels in the band below any of the positives' scores."""
    wanted = anchors["wanted"]  # members by positives, scores of the positives; below zero no band holds anything
    best = _Best(*wanted.shape, most)
    floor = np.where(wanted >= 0, -(-low * wanted // high), np.iinfo(np.int64).max)

    def needs():
        return np.maximum(best.least(), floor)

    def meet(part, at, scores):
        need, top = needs()[part], wanted[part]
        fits = (shard.labels[at][None, :] != anchors["label"][part][:, None]) & (scores >= need.min(axis=1)[:, None]) & (scores <= top.max(axis=1)[:, None])
        m, c = np.nonzero(fits)
        s = scores[m, c]
        for wish in range(wanted.shape[1]):
            use = np.flatnonzero((s >= need[m, wish]) & (s <= top[m, wish]))
            best.add(part[m[use]], wish, s[use], at[c[use]], shard.rank)

    shard.walk(anchors["v"], anchors["norm"], lambda: needs().min(axis=1), meet)
    m, w, k = np.nonzero(best.at >= 0)
    pairs = np.unique(np.stack([m, best.at[m, w, k], best.score[m, w, k]]), axis=1) if len(m) else np.zeros((3, 0), np.int64)
    return list(pairs)


def _meetings(find: Callable):
    """Reads (shard, block) groups in order: candidates first, then anchors by cluster; the anchors of a cluster walk together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, shard = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)])  # shard, block, kind, cluster
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for s, e in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(batch)].tolist()):
                if e == s:
                    continue
                now = tuple(keys[:, s].tolist())
                if now[:2] != key:
                    key, parts, shard = now[:2], [], None
                run_ = batch.slice(s, e - s)
                if now[2] == 0:
                    parts.append(run_)
                    continue
                if shard is None:
                    if not parts:
                        continue  # anchors of a shard without rows
                    shard = _shard(parts)
                    parts = []
                members = {
                    "row": run_.column("row").to_numpy(), "label": run_.column("label").to_numpy(),
                    "v": _matrix(run_.column("v")), "norm": run_.column("norm").to_numpy(),
                    "wanted": _filled(run_.column("wanted")),
                }
                m, c, score = find(shard, members)
                if len(m):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(members["row"][m]), pa.array(shard.rows[c]), shard.ids.take(pa.array(c)), pa.array(score)],
                        names=["anchor", "other", "other_id", "score"])

    return run


def _filled(wanted: pa.Array) -> np.ndarray:
    """Lists of scores as rows; shorter ones end in -1."""
    lists = wanted.to_pylist()
    width = max((len(x) for x in lists if x), default=1)
    return np.array([(x or []) + [-1] * (width - len(x or [])) for x in lists], dtype=np.int64).reshape(len(lists), width)


def _shard(parts: list[pa.RecordBatch]) -> Shard:
    whole = pa.Table.from_batches(parts).combine_chunks()
    one = lambda name: whole.column(name).chunk(0)
    return Shard(one("row").to_numpy(), one("vec_id"), one("label").to_numpy(), _matrix(one("v")), one("norm").to_numpy())


def _met(rows: DataFrame, anchors: DataFrame, shards: int, blocks: int, find: Callable) -> DataFrame:
    """``anchor``, ``other`` (row numbers), ``other_id`` and ``score`` of what ``find`` finds where anchors meet shards."""
    place = lambda by, n: F.pmod(F.xxhash64("row", F.lit(by)), F.lit(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    columns = ["shard", "block", "kind", "cluster", "row", "vec_id", "label", "v", "norm", "wanted"]
    none = F.lit(None).cast("array<long>")
    dealt = rows.withColumn("shard", place("s", shards)).withColumn("block", every(blocks)).withColumn("kind", F.lit(0).cast("long"))
    dealt = dealt.withColumn("cluster", F.lit(0).cast("long")).withColumn("wanted", none).select(*columns)
    sent = anchors.withColumn("block", place("b", blocks)).withColumn("shard", every(shards)).withColumn("kind", F.lit(1).cast("long"))
    both = dealt.unionAll(sent.select(*columns))
    return (
        both.repartition("shard", "block").sortWithinPartitions("shard", "block", "kind", "cluster")
        .mapInArrow(_meetings(find), "anchor long, other long, other_id long, score long")
    )


def _clustered(anchors: DataFrame, centre: np.ndarray) -> DataFrame:
    """``anchors`` with the number of the nearest centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"))
            width = max(v.shape[1], centre.shape[1])
            at = np.argmax(_wide(v, width) @ _wide(centre, width).T, axis=1) if len(v) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "cluster"])

    return anchors.mapInArrow(run, f"{_ddl(anchors)}, cluster long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _firsts(found: DataFrame, by: Sequence[str], most: int, name: str) -> DataFrame:
    """The best ``most`` rows of each group, numbered; a map-side limit goes before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_last(), "other")
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= most)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    For every anchor and each of its first ``positives`` other rows of the same label, the first ``negatives`` rows of other labels whose
    score is at least ``low`` / ``high`` of the positive's and at most the positive's. Higher scores come first, ties by the smaller id (null last).
    ``is_anchor`` is a condition on the columns of ``rows``; null counts as false. Ids and labels are whole numbers.

    Rows with a null label, a null vector or a null or non-finite component take no part, nor do vectors whose scaled
    length reaches 2 ** 28 (the hundredfold of their scores may not fit a long). Shorter vectors are taken to end in zeros; an empty one scores 0. Every row counts, also one
    that repeats an id or a whole row: "other" means another row. A positive without a negative in its band gives no row, nor does one
    with a score below zero. An empty table gives an empty result. Other columns, whatever their names, are not read.
    """
    spark = rows.sparkSession
    used = rows.select(
        col(vec_id).cast("long").alias("vec_id"), col(label).cast("long").alias("label"), col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    table = materialised(prepared(used, scale), "vectors")
    n, held, n_anchors = table.agg(F.count("*"), F.sum(8 * F.size("v")), F.count_if("anchor")).first()
    wide = min(-(-n // SHARD_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards, blocks = max(-(-(held or 0) // SHARD_BYTES), wide, 1), max(-(-n_anchors // ANCHORS), 1)
    columns = ["row", "vec_id", "label", "v", "norm"]
    anchors = table.filter("anchor").select(*columns)
    sample = [r.v for r in anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").collect()]
    centre = np.zeros((1, 1))
    if sample:
        fitted = _matrix(pa.array(sample, pa.list_(pa.float64())))
        centre = centres(fitted, min(max(-(-n_anchors // CLUSTER), 1), CLUSTERS, len(sample)))
    anchors = materialised(_clustered(anchors, centre), "anchors")
    table = table.select(*columns)

    first = anchors.withColumn("wanted", F.lit(None).cast("array<long>"))
    near = _firsts(_met(table, first, shards, blocks, lambda s, a: _positives(s, a, positives)), ["anchor"], positives, "place")
    near = materialised(near.select("anchor", "place", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    wanted = near.filter("positive_score >= 0").groupBy("anchor").agg(F.collect_set("positive_score").alias("wanted"))
    second = anchors.join(wanted, F.col("row") == F.col("anchor")).select(*anchors.columns, "wanted")
    below = _met(table, second, shards, blocks, lambda s, a: _negatives(s, a, negatives, low, high))
    band = (low * F.col("positive_score") <= high * F.col("score")) & (F.col("score") <= F.col("positive_score"))
    pairs = _firsts(near.join(below, "anchor").filter(band), ["anchor", "place"], negatives, "rank")
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return pairs.join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
