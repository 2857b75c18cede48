"""Exact top-k inner products by no-random-access aggregation (NRA).

Every vector component is a sorted list; a query walks all lists in step,
from the end that contributes most to its score. What has been read gives
each vector a lower bound (unread components at the list's worst) and an
upper bound (unread components at the depth reached). Reading stops when at
most ``survivors`` vectors have an upper bound that reaches the k-th best
lower bound: no outsider can qualify, and ties are not cut. The survivors'
scores are then resolved by reading their remaining components.

Vectors are dealt into blocks of about ``block_rows`` by their row number; each
block has its own lists, and the stated query set passes over every block. A
task holds one block; the queries follow it in the same sorted partition and are
read a few at a time, so a vector moves once, and what moves of the queries (one
row in ``query_every``) is one copy per block. Lists are read for some queries
at a time: one round takes all lists to the next depth; what is read by then is
held as a matrix that is zero elsewhere, so a round's bounds are matrix
products. Products and sums of quantized components are whole numbers below
2**24, which float32 keeps exactly, or below 2**53 in float64. Beyond, bounds
carry their rounding error and survivors are resolved in Python's whole numbers.

Defined results: null vectors, those with null or non-finite components and
those without a vec_id take no part; vectors of one length are compared, each
length for itself; components are clamped to +-2**61 after scaling and scores to
a long; repeated rows are separate candidates, but a row that has the query's
own vec_id is none; every query row has ranks of its own, repeated ones the same
ranks; ties go to the smaller vec_id; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written


CLAMP = 2.0**61
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class TopKSettings:
    k: int = 20
    query_every: int = 20
    scale: int = 64
    block_rows: int = 16384
    query_rows: int = 128  # that pass over a block together
    depths: tuple[float, ...] = (0.5, 0.85, 1.0)  # of the lists, where bounds are compared
    survivors: int = 200


def quantize(vectors: DataFrame, settings: TopKSettings) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, as longs, of the
    vectors that take part."""
    def whole(x):
        scaled = F.lit(float(settings.scale)) * x.cast("double")
        return F.floor(F.greatest(F.lit(-CLAMP), F.least(F.lit(CLAMP), scaled))).cast("long")

    # not-a-number compares as the largest double in Spark
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))


class Lists:
    """The sorted lists of one block of vectors (rows of ``x``).

    ``rounds`` has, for each depth, what is read by then: a matrix of the
    components read from the high end, those read from the low end, and the
    marks of those unread from either end, and the values at that depth.
    """

    def __init__(self, rows: np.ndarray, depths: tuple[float, ...], kind):
        x = rows.astype(kind or np.float64)
        n, dims = x.shape
        self.x, self.low, self.high = x, x.min(axis=0), x.max(axis=0)
        # without a float type that keeps all sums whole: the rows themselves, and how far a sum may be off
        self.rows = None if kind else rows
        self.reach = np.abs(x).max(axis=0) * (dims + 4) * 2.0**-51
        order = np.argsort(x, axis=0, kind="stable")
        ranked = np.take_along_axis(x, order, axis=0)
        place = np.empty_like(order)  # the place of each component in its ascending list
        np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
        self.rounds = []
        for stop in sorted({min(n, math.ceil(d * n)) for d in depths}):
            top, bottom = place >= n - stop, place < stop
            state = np.hstack([x * top, x * bottom, (~top).astype(x.dtype), (~bottom).astype(x.dtype)])
            self.rounds.append((state, ranked[n - stop], ranked[stop - 1], stop == n))


    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The exact scores of some rows."""
        if self.rows is None:
            return (self.x[rows] @ q.astype(self.x.dtype)).astype(np.int64)
        exact = self.rows[rows].astype(object) @ q.astype(object)
        return np.array([max(-LONG, min(LONG, int(v))) for v in exact], dtype=np.int64)


def nra(lists: Lists, q: np.ndarray, k: int, survivors: int, own: np.ndarray):
    """For each row of ``q``: (row numbers, scores) of the vectors that may be
    among its k best. ``own`` marks (query, vector) pairs that take no part.

    A positive query component reads its list from the high end, a negative
    one from the low end."""
    x, dtype = lists.x, lists.x.dtype
    slack = np.zeros(len(q), dtype=dtype) if lists.rows is None else np.abs(q.astype(dtype)) @ lists.reach
    up, down = np.maximum(q, 0).astype(dtype), np.minimum(q, 0).astype(dtype)  # queries x dims
    open_ = np.arange(len(q))
    out: list = [None] * len(q)
    for state, reach_high, reach_low, last in lists.rounds:
        u, d = up[open_], down[open_]
        # what is read counts as it is; what is unread at the list's worst, or at the depth reached
        lower = np.hstack([u, d, u * lists.low, d * lists.high]) @ state.T
        upper = np.hstack([u, d, u * reach_high, d * reach_low]) @ state.T
        lower[own[open_]] = upper[own[open_]] = -np.inf
        kth = np.partition(lower, len(x) - k, axis=1)[:, len(x) - k] if len(x) > k else np.full(len(open_), -np.inf)
        alive = (upper >= (kth - 2 * slack[open_])[:, None]) & ~own[open_]
        done = (alive.sum(axis=1) <= survivors) | last
        for j in np.flatnonzero(done):
            rows = np.flatnonzero(alive[j])
            out[open_[j]] = rows, lists.scores(rows, q[open_[j]])  # resolve the final scores
        open_ = open_[~done]
        if not len(open_):
            break
    return out


def _exact_type(x: np.ndarray):
    """The float type that keeps every partial sum whole; None beyond."""
    bound = float(np.abs(x).max(initial=0)) ** 2 * x.shape[1]
    return np.float32 if bound < 2.0**23 else np.float64 if bound < 2.0**53 else None


def top_k(vectors: DataFrame, settings: TopKSettings = TopKSettings()) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query."""
    rows = written(quantize(vectors, settings).withColumn("row", F.monotonically_increasing_id()), "vectors")
    blocks = max(1, math.ceil(rows.count() / settings.block_rows))
    # equal query rows are searched once
    asked = rows.where(F.pmod("vec_id", F.lit(settings.query_every)) == 0).groupBy("vec_id", "v").agg(
        F.min("row").alias("row"), F.count("*").alias("copies")
    )
    asked = written(asked, "queries")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("b")
    held = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("b"), F.lit(0).alias("asks"), "row", "vec_id", "v")
    passing = asked.select(every, F.lit(1).alias("asks"), "row", "vec_id", "v")
    met = held.unionByName(passing).withColumn("dims", F.size("v"))
    laid = met.repartition("b", "dims").sortWithinPartitions("b", "dims", "asks", "row")
    k, survivors, depths, together = settings.k, settings.survivors, settings.depths, settings.query_rows
    columns = ["query", "query_id", "vec_id", "score"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, parts, lists, x_most = None, [], {}, 0

        def answer(queries: pd.DataFrame) -> Iterator[pd.DataFrame]:
            x, ids = parts[0]
            for a in range(0, len(queries), together):
                some = queries.iloc[a : a + together]
                q, names = np.stack(some["v"]), some["vec_id"].to_numpy()
                kind = _exact_type(np.array([[x_most, np.abs(q).max(initial=0)]] * x.shape[1]).T)
                if kind not in lists:
                    lists[kind] = Lists(x, depths, kind)
                own = ids[None, :] == names[:, None]
                out = []
                for number, name, (alive, scores) in zip(some["row"], names, nra(lists[kind], q, k, survivors, own)):
                    best = np.lexsort((ids[alive], -scores))[:k]
                    out.append((np.full(len(best), number), np.full(len(best), name), ids[alive][best], scores[best]))
                yield pd.DataFrame({c: np.concatenate(v) for c, v in zip(columns, zip(*out))})

        for pdf in batches:
            for key, part in pdf.groupby(["b", "dims", "asks"], sort=False):
                if key[:2] != block:
                    block, parts, lists = key[:2], [], {}
                if not key[2]:
                    parts.append((np.stack(part["v"]), part["vec_id"].to_numpy()))
                elif parts and key[1]:
                    if len(parts) > 1 or not lists:
                        parts = [(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
                        x_most = np.abs(parts[0][0]).max(initial=0)
                    yield from answer(part)

    found = laid.mapInPandas(search, "query long, query_id long, vec_id long, score long")
    # a query's k best of every block meet: k rows a block and query
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    copies = asked.select(F.col("row").alias("query"), "copies")
    return ranked.join(copies, "query").select("query_id", "rank", "vec_id", "score", again.alias("copy")).drop("copy")


# DuckDB SQL for ``top_k`` over embeddings.
SQL = """
with v as (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (
  select q.rid, q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e) where q.vec_id % 20 = 0 and len(q.e) > 0),
r as (select *, row_number() over (partition by rid order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""
