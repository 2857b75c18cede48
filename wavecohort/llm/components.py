"""Connected components by alternating large and small stars (Kiveris et al.,
2014): every pass is two group-minimum joins, and the number of passes grows
with the logarithm of the longest path. Edges are written to the shared
folder after each pass; nothing but two counters reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and its neighbours v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down)
    out = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        starred.select("u", F.col("m").alias("v"))
    )
    return out.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge and is not its own root;
    ``edges`` are (u, v) longs, root is the least node of the component."""
    edges = written(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
