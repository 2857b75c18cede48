"""Centroid clustering in whole numbers; the nearest centroid of a vector is
found by the threshold algorithm.

Each dimension has the list of all centroids sorted by their component. A
vector enters every list at its own value and walks outward, always to the
nearer of the two neighbours not yet read. A centroid met for the first time in
any list has its exact squared distance computed. The frontier of a list is the
distance of the value read last in it: a centroid not met yet is at least as far
in every dimension, so at least the sum of squared frontiers away. The walk
stops when that sum strictly exceeds the best exact distance (ties stay open),
or when every list is read.

Spark deals the vectors; a task walks a block of them in step (arrays of
vectors by dimensions), so its memory is bounded by ``block`` whatever the
table holds. A round sends, per task, one row per cluster and dimension: the
sums as two halves of whole numbers, added as decimals, so that means are exact
at any size. Centroids (``clusters`` rows) are all the driver sees.

Defined results: vectors that are null, have another number of components than
``dims``, or hold a null, infinite or not-a-number component take no part;
components are clamped to +-2**61 after scaling; a squared distance or inertia
beyond a long is reported as the largest long (the clustering itself is exact);
repeated rows are separate vectors, also as first centroids (vectors of one
vec_id in order of their components); a null vec_id is hashed as the text
``null``; with fewer vectors than ``clusters`` each is a centroid; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LARGEST = (1 << 63) - 1
CLAMP = 1 << 61


@dataclass(frozen=True)
class CentroidSettings:
    clusters: int = 40
    rounds: int = 5
    dims: int = 64
    scale: int = 256
    seed: int = 2
    block: int = 512  # vectors that a task walks in step


def quantize(vectors: DataFrame, settings: CentroidSettings) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, of the vectors that
    take part."""
    # not-a-number compares as the largest double in Spark
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    usable = vectors.where((F.size("embedding") == settings.dims) & finite)
    bound = float(CLAMP)

    def whole(x):
        scaled = F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), F.lit(float(settings.scale)) * x.cast("double"))))
        return scaled.cast("long")

    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))


def first_centroids(rows: DataFrame, settings: CentroidSettings) -> list[list[int]]:
    """The vectors with the smallest hashes, in their order."""
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    picked = rows.orderBy(F.sha2(name, 256), "v").limit(settings.clusters).collect()  # at most ``clusters``
    return [list(r["v"]) for r in picked]


class SortedLists:
    """Per dimension, the centroids sorted by their component."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids  # clusters x dims
        order = np.argsort(centroids, axis=0, kind="stable")
        self.order = order.T.copy()  # dims x clusters: centroid numbers
        self.values = np.take_along_axis(centroids, order, axis=0).T.copy()


def nearest(x: np.ndarray, lists: SortedLists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, list steps) of every row of ``x``, by the
    threshold algorithm. Works on int64 and, for large values, on Python
    whole numbers (dtype object)."""
    n, dims = x.shape
    k = len(lists.centroids)
    every = np.arange(dims)[None, :]
    # the first entry of each list that isn't below the vector's value
    right = np.stack([np.searchsorted(lists.values[d], x[:, d], side="left") for d in range(dims)], axis=1)
    left = right - 1
    seen = np.zeros((n, k), dtype=bool)
    best = np.full(n, -1, dtype=np.int64)
    distance = np.zeros(n, dtype=x.dtype)
    steps = np.zeros(n, dtype=np.int64)
    open_ = np.arange(n)
    while len(open_):
        value, lo, hi = x[open_], left[open_], right[open_]
        # squares of what lies next on either side; an ended side is marked
        below = value - lists.values[every, np.maximum(lo, 0)]
        above = lists.values[every, np.minimum(hi, k - 1)] - value
        down = (lo >= 0) & ((hi >= k) | (below <= above))
        frontier = np.where(down, below, above)
        met = lists.order[every, np.where(down, lo, hi)]
        left[open_] -= down
        right[open_] += ~down
        steps[open_] += 1
        fresh = np.zeros((len(open_), k), dtype=bool)
        fresh[np.arange(len(open_))[:, None], met] = True
        fresh &= ~seen[open_]
        seen[open_] |= fresh
        rows, found = np.nonzero(fresh)  # centroids ascend within a row
        if len(rows):
            gap = value[rows] - lists.centroids[found]
            exact = (gap * gap).sum(axis=1)
            # of each row the least distance, then the least centroid
            order = np.lexsort((found, exact, rows)) if exact.dtype != object else np.array(
                sorted(range(len(rows)), key=lambda i: (rows[i], exact[i], found[i])), dtype=np.int64)
            first = order[np.unique(rows[order], return_index=True)[1]]
            at, new, number = open_[rows[first]], exact[first], found[first]
            better = (best[at] < 0) | (new < distance[at]) | ((new == distance[at]) & (number < best[at]))
            better = better.astype(bool)
            best[at[better]], distance[at[better]] = number[better], new[better]
        threshold = (frontier * frontier).sum(axis=1)
        ended = (threshold > distance[open_]).astype(bool) | (steps[open_] >= k)
        open_ = open_[~ended]
    return best, distance, steps


# the squares of gaps below 2**28 add up to a long over 64 and more dimensions
EXACT_GAP = 1 << 27


def _blocks(vectors: pd.Series, centroids: list[list[int]], block: int):
    """Yields (rows, cluster, distance as Python or numpy whole numbers, x)."""
    small = SortedLists(np.array(centroids, dtype=np.int64))
    reach = int(np.abs(small.centroids).max(initial=0))
    large = None
    for a in range(0, len(vectors), block):
        x = np.stack(vectors.iloc[a : a + block].to_numpy()).astype(np.int64)
        plain = np.abs(x).max(axis=1) < EXACT_GAP if reach < EXACT_GAP else np.zeros(len(x), dtype=bool)
        for rows, wide in ((np.flatnonzero(plain), False), (np.flatnonzero(~plain), True)):
            if not len(rows):
                continue
            if wide and large is None:
                large = SortedLists(small.centroids.astype(object))
            cluster, distance, _ = nearest(x[rows].astype(object) if wide else x[rows], large if wide else small)
            yield a + rows, cluster, distance, x[rows]


def cluster_sums(rows: DataFrame, centroids: list[list[int]], settings: CentroidSettings) -> dict:
    """(cluster, dimension) -> (count, exact sum); at most clusters x dims
    rows reach the driver."""
    k, dims, block = len(centroids), settings.dims, settings.block

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(k, dtype=np.int64)
        halves = np.zeros((2, k, dims), dtype=np.int64)  # v = high * 2**32 + low

        def flush():
            some = np.flatnonzero(counts)
            c, d = np.repeat(some, dims), np.tile(np.arange(dims), len(some))
            out = {"cluster": c, "dim": d, "n": counts[c], "high": halves[0][c, d], "low": halves[1][c, d]}
            return pd.DataFrame(out)

        rows_held = 0
        for pdf in batches:
            for _, cluster, _, x in _blocks(pdf["v"], centroids, block):
                np.add.at(halves[0], cluster, x >> 32)
                np.add.at(halves[1], cluster, x & 0xFFFFFFFF)
                counts += np.bincount(cluster, minlength=k)
                rows_held += len(x)
            if rows_held >= 1 << 28:  # halves stay far below a long
                yield flush()
                counts[:], halves[:], rows_held = 0, 0, 0
        yield flush()

    each = rows.mapInPandas(add, "cluster int, dim int, n long, high long, low long")
    wide = "decimal(38,0)"
    sums = each.groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")
    )
    return {(r["cluster"], r["dim"]): (r["n"], int(r["high"]) * (1 << 32) + int(r["low"])) for r in sums.collect()}


def moved(centroids: list[list[int]], sums: dict) -> list[list[int]]:
    """Every non-empty centroid becomes its vectors' floored mean."""
    out = []
    for c, old in enumerate(centroids):
        found = [sums.get((c, d)) for d in range(len(old))]
        out.append([total // n for n, total in found] if found and found[0] else old)
    return out


def fit(rows: DataFrame, settings: CentroidSettings) -> list[list[int]]:
    """The final centroids of quantized ``rows`` (a written table)."""
    centroids = first_centroids(rows, settings)
    for _ in range(settings.rounds if centroids else 0):
        centroids = moved(centroids, cluster_sums(rows, centroids, settings))
    return centroids


def assign(rows: DataFrame, centroids: list[list[int]], settings: CentroidSettings) -> DataFrame:
    """vec_id, cluster and exact (decimal) squared distance of every vector."""
    block = settings.block

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at, cluster, distance, _ in _blocks(pdf["v"], centroids, block):
                exact = [Decimal(int(d)) for d in distance]
                ids = pdf["vec_id"].astype("Int64").iloc[at].to_numpy(dtype=object, na_value=None)
                yield pd.DataFrame({"vec_id": pd.array(ids, dtype="Int64"), "cluster": cluster, "exact": exact})

    # 64 squares of 2**62 stay below 10**38
    return rows.mapInPandas(walk, "vec_id long, cluster int, exact decimal(38,0)")


def clamp_long(value: Column) -> Column:
    return F.least(value, F.lit(Decimal(LARGEST)).cast("decimal(38,0)")).cast("long")


def cluster(vectors: DataFrame, settings: CentroidSettings = CentroidSettings()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and
    centroid_sha256 of every vector that takes part."""
    rows = written(quantize(vectors, settings), "cluster-vectors")
    centroids = fit(rows, settings)
    found = written(assign(rows, centroids, settings), "cluster-assigned")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("exact").alias("s")).collect()}  # one row per cluster
    total = min(int(sum(inertia.values(), Decimal(0))), LARGEST)
    schema = "cluster int, cluster_inertia long, centroid_sha256 string"
    names = [
        (c, min(int(inertia.get(c, 0)), LARGEST), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
        for c, v in enumerate(centroids)
    ]
    per_cluster = F.broadcast(vectors.sparkSession.createDataFrame(names, schema))  # ``clusters`` rows
    return found.join(per_cluster, "cluster").select(
        "vec_id", "cluster", clamp_long(F.col("exact")).alias("distance"), "cluster_inertia",
        F.lit(total).cast("long").alias("inertia"), "centroid_sha256",
    )


def sql(settings: CentroidSettings = CentroidSettings()) -> str:
    """DuckDB SQL for ``cluster`` over embeddings: all distances, one group of
    common table expressions per round."""
    head = f"""
with v as materialized (
  select row_number() over () as rid, vec_id,
    list_transform(embedding, lambda x: cast(floor({settings.scale} * cast(x as double)) as bigint)) as e
  from embeddings
  where len(embedding) = {settings.dims}
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
c0 as materialized (
  select row_number() over (order by h, e) - 1 as c, e
  from (select sha256('{settings.seed}:' || coalesce(cast(vec_id as varchar), 'null')) as h, e from v
    order by h, e limit {settings.clusters}))"""
    parts = [head]
    for r in range(settings.rounds + 1):
        parts.append(f"""
n{r} as materialized (
  select rid, arg_min(c, struct_pack(d := d, c := c)) as c, min(d) as d
  from (select rid, c, list_sum(list_transform(list_zip(v.e, k.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d from v, c{r} k)
  group by rid)""")
        if r < settings.rounds:
            parts.append(f"""
c{r + 1} as materialized (
  select k.c, coalesce(m.e, k.e) as e
  from c{r} k left join (
    select c, list((s - ((s % n) + n) % n) // n order by i) as e
    from (select c, i, cast(sum(x) as hugeint) as s, count(*) as n
      from (select n{r}.c, unnest(v.e) as x, generate_subscripts(v.e, 1) as i from v join n{r} using (rid)) group by c, i)
    group by c) m on m.c = k.c)""")
    last = settings.rounds
    tail = f"""
select vec_id, cast(n.c as integer) as cluster, cast(n.d as bigint) as distance,
  cast(sum(n.d) over (partition by n.c) as bigint) as cluster_inertia, cast(sum(n.d) over () as bigint) as inertia,
  sha256(array_to_string(k.e, ',')) as centroid_sha256
from n{last} n join v using (rid) join c{last} k on k.c = n.c
"""
    return ",".join(parts) + tail
