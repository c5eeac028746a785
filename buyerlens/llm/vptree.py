"""Nearest neighbours by vantage-point trees, one per shard.

Rows are routed to the nearest of a bounded number of pivots (fitted on a
bounded sample; every row is indexed), and a pivot's rows are dealt by hash to
shards of bounded size, so no shard grows with a hot spot. Each shard is
searched through a vantage-point tree. A query first searches the shards of
its own pivot, which gives its distance to beat; then those of every pivot
whose ball can hold something nearer. A ball or subtree is left out if
``factor`` times its triangle-inequality bound exceeds the distance to beat:
factor one is exact, a larger one prunes more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.llm.base import cut, kmeans, matrix, prepare, valid_vector

FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class SearchParams:
    k: int = 10
    factor: float = 1.1
    shard_rows: int = 1024
    query_rows: int = 2048  # queries that meet a shard in one group
    max_pivots: int = 256
    sample: int = 16_384  # rows the pivots are fitted on
    leaf: int = 64
    seed: int = 11


# --- one shard's tree ------------------------------------------------------

class Tree:
    """A vantage-point tree over the rows of ``x``; searched for many queries at once."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int, seed: int):
        order = np.argsort(ids, kind="stable")
        self.x, self.ids, self.leaf = x[order], ids[order], leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(ids)))

    def _grow(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        vantage = rows[self.rng.integers(len(rows))]
        d = distances(self.x[vantage:vantage + 1], self.x[rows])[0]
        middle = np.median(d)
        inner = d <= middle
        if inner.all():  # many equal rows: any halves will do
            inner = np.arange(len(rows)) < len(rows) // 2
        halves = [(rows[m], d[m].min(), d[m].max()) for m in (inner, ~inner)]
        return vantage, [(self._grow(r), lo, hi) for r, lo, hi in halves]

    def search(self, q: np.ndarray, own: np.ndarray, beat: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Per query the ``k`` nearest ids and distances (infinite where there are fewer), its own id left out.

        ``beat``: a distance known to hold ``k`` rows elsewhere; farther rows are not looked for.
        """
        self.q, self.own, self.k, self.factor = q, own, k, factor
        self.beat = beat.astype(np.float64).copy()
        self.d = np.full((len(q), k), np.inf)
        self.got = np.full((len(q), k), np.iinfo(np.int64).max)
        if len(self.ids):
            self._visit(self.root, np.arange(len(q)))
        return self.got, self.d

    def _visit(self, node, who: np.ndarray) -> None:
        if not len(who):
            return
        if isinstance(node, np.ndarray):
            d = distances(self.q[who], self.x[node])
            d[self.own[who][:, None] == self.ids[node][None, :]] = np.inf
            self._merge(who, np.broadcast_to(self.ids[node], d.shape), d)
            return
        vantage, halves = node
        d = distances(self.q[who], self.x[vantage:vantage + 1])[:, 0]
        away = [np.maximum(np.maximum(lo - d, d - hi), 0) for _, lo, hi in halves]
        first = away[1] < away[0]  # the half that is nearer
        for near in (True, False):
            for side in (0, 1):
                mine = (first == bool(side)) == near
                go = mine & (self.factor * away[side] <= self.beat[who])
                self._visit(halves[side][0], who[go])

    def _merge(self, who: np.ndarray, ids: np.ndarray, d: np.ndarray) -> None:
        alld = np.concatenate([self.d[who], d], axis=1)
        alli = np.concatenate([self.got[who], ids], axis=1)
        best = np.lexsort((alli, alld), axis=1)[:, :self.k]
        self.d[who] = np.take_along_axis(alld, best, 1)
        self.got[who] = np.take_along_axis(alli, best, 1)
        self.beat[who] = np.minimum(self.beat[who], self.d[who][:, -1])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows, from differences in double precision."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 20) // max(1, b.size))
    for i in range(0, len(a), step):
        out[i:i + step] = np.sqrt(np.square(a[i:i + step, None, :] - b[None, :, :]).sum(axis=2))
    return out


# --- Spark -----------------------------------------------------------------

@dataclass
class Index:
    rows: DataFrame  # id, v, shard
    pivots: np.ndarray
    near: np.ndarray  # per pivot: distance of its nearest row
    far: np.ndarray  # per pivot: of its farthest row
    shards: np.ndarray  # per pivot: number of shards; their numbers follow each other
    dim: int


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """``(id, v array<double>)`` of the rows that can take part, and their dimension: the most frequent one."""
    rows = vectors.where(valid_vector(vec_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    dims = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = dims["n"] if dims else 0
    return rows.where(F.size("v") == dim), dim


def build(vectors: DataFrame, p: SearchParams = SearchParams(), id_col: str = "vec_id", vec_col: str = "embedding") -> Index | None:
    """The routed rows (checkpointed), or None if no row is usable."""
    prepare(vectors.sparkSession)
    rows, dim = usable(vectors, id_col, vec_col)
    n = rows.count()
    if n == 0:
        return None
    sample = matrix(r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(p.sample).collect())
    pivots = kmeans(sample, int(np.clip(-(-n // p.shard_rows), 1, p.max_pivots)), 8, p.seed)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = distances(matrix(b["v"]).reshape(-1, dim), pivots)
            b["pivot"] = d.argmin(axis=1).astype(np.int32)
            b["d"] = d.min(axis=1)
            yield b

    routed = cut(rows.mapInPandas(route, "id long, v array<double>, pivot int, d double"))
    near, far, shards = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64)
    for r in routed.groupBy("pivot").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count(F.lit(1)).alias("n")).collect():
        near[r["pivot"]], far[r["pivot"]], shards[r["pivot"]] = r["lo"], r["hi"], -(-r["n"] // p.shard_rows)
    first = np.cumsum(shards) - shards
    at = lambda a: F.element_at(F.array(*[F.lit(int(x)) for x in a]), F.col("pivot") + 1)
    salt = F.pmod(F.xxhash64("id"), at(np.maximum(shards, 1)).cast("long"))
    return Index(routed.select("id", "v", (at(first) + salt).cast("int").alias("shard")), pivots, near, far, shards, dim)


def _visits(queries: DataFrame, index: Index, p: SearchParams, own: bool) -> DataFrame:
    """``(query_id, q, beat, shard)``: the own pivot's shards, or those of the others that may hold something nearer."""
    pivots, near, far, shards, dim = index.pivots, index.near, index.far, index.shards, index.dim
    first = np.cumsum(shards) - shards

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = distances(matrix(b["q"]).reshape(-1, dim), pivots)
            home = np.argmin(np.where(shards > 0, d, np.inf), axis=1)
            mine = np.arange(len(pivots))[None, :] == home[:, None]
            away = np.maximum(np.maximum(near - d, d - far), 0)
            take = mine if own else ~mine & (shards > 0) & (p.factor * away <= b["beat"].to_numpy()[:, None])
            b["shard"] = [[int(first[j] + s) for j in np.flatnonzero(t) for s in range(shards[j])] for t in take]
            yield b

    out = queries.mapInPandas(go, "query_id long, q array<double>, beat double, shard array<int>")
    return out.withColumn("shard", F.explode("shard"))


def _search(visits: DataFrame, index: Index, p: SearchParams) -> DataFrame:
    """``(query_id, vec_id, score)``: the nearest of each visited shard. A shard with many queries meets them in several groups."""
    visits = cut(visits)
    groups = visits.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / p.query_rows).cast("int").alias("n"))
    rows = index.rows.join(groups, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
    asked = visits.join(groups, "shard").withColumn("part", F.pmod(F.xxhash64("query_id"), "n").cast("int")).drop("n")

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        tree = Tree(matrix(left["v"]), left["id"].to_numpy(np.int64), p.leaf, p.seed)
        own = right["query_id"].to_numpy(np.int64)
        ids, d = tree.search(matrix(right["q"]), own, right["beat"].to_numpy(np.float64), p.k, p.factor)
        hit = np.isfinite(d) & (d <= right["beat"].to_numpy(np.float64)[:, None])
        return pd.DataFrame({"query_id": np.repeat(own, hit.sum(1)), "vec_id": ids[hit], "score": d[hit]})

    return rows.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInPandas(look, FOUND)


def _nearest(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, p: SearchParams = SearchParams(), id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``p.k`` nearest rows of ``vectors``, itself (by id) left out.

    Vectors that are null, zero, of another length than most, or hold null or
    non-finite components take no part on either side, nor do null ids. Ties go
    to the smaller id; repeated rows of an id are repeated candidates, repeated
    queries count once; an empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    index = build(vectors, p, id_col, vec_col)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if index is None:
        return empty
    asked = queries.where(valid_vector(vec_col, index.dim) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("q")).dropDuplicates(["query_id"])
    asked = cut(asked)
    near = cut(_nearest(_search(_visits(asked.withColumn("beat", F.lit(float("inf"))), index, p, True), index, p), p.k))
    beat = near.groupBy("query_id").agg(F.max("score").alias("far"), F.count(F.lit(1)).alias("n"))
    known = asked.join(beat, "query_id", "left").select(
        "query_id", "q", F.when(F.col("n") >= p.k, F.col("far")).otherwise(F.lit(float("inf"))).alias("beat"))
    other = _search(_visits(known, index, p, False), index, p)
    return _nearest(near.select("query_id", "vec_id", "score").unionByName(other), p.k).select("query_id", "rank", "vec_id", "score")
