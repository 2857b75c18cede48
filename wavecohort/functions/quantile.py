"""Exact type-7 quantiles without sending every distinct value to one task.

``percentile`` keeps a value->count map per group; for a continuous column
the global map holds nearly all rows in the final task. Instead:

1. Rows are counted per value (partial counts collapse ties map-side) and the
   (value, count) pairs are range-partitioned by value; the result is a
   stage boundary, so the ranges are fixed.
2. One row per range, its count, gives by a running sum the range and the
   place inside it of every order statistic that any probability needs.
3. Only those ranges are read again; a running count inside each finds the
   values, and two rows per probability reach the driver.

The same steps serve any size and any number of ties.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def type7_ranks(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    """0-based ranks of the two order statistics of each probability and the
    weight of the upper one, as R's ``quantile(type = 7)``."""
    out = []
    for p in probs:
        h = (n - 1) * p
        low = math.floor(h)
        out.append((low, min(low + 1, n - 1), h - low))
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float]:
    return [low + w * (high - low) for low, high, w in order_statistics(df, col, probs)]


def order_statistics(df: DataFrame, col: str, probs: Sequence[float]) -> list[tuple[float, float, float]]:
    """For every probability the two order statistics around its type-7
    quantile and the weight of the upper one. A function that keeps order (a
    clamp, say) may be applied to them in the place of all values."""
    values = df.select(F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    counts = values.groupBy("_x").agg(F.count(F.lit(1)).alias("_c"))
    ranged = materialize(counts.repartitionByRange("_x").withColumn("_part", F.spark_partition_id()))
    parts = ranged.groupBy("_part").agg(F.sum("_c").alias("_n"), F.min("_x").alias("_low"))
    parts = sorted(parts.collect(), key=lambda r: r["_low"])  # one row per range
    n = sum(r["_n"] for r in parts)
    if not n:
        return [(float("nan"), float("nan"), 0.0)] * len(probs)
    ranks = type7_ranks(n, probs)
    wanted = {}  # (range, place inside it) -> rank
    for rank in {r for low, high, _ in ranks for r in (low, high)}:
        before = 0
        for r in parts:
            if rank < before + r["_n"]:
                wanted[r["_part"], rank - before] = rank
                break
            before += r["_n"]
    upto = F.sum("_c").over(Window.partitionBy("_part").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    near = ranged.where(F.col("_part").isin(sorted({p for p, _ in wanted}))).withColumn("_upto", upto)
    hit = F.lit(False)
    for part, place in wanted:
        hit = hit | ((F.col("_part") == part) & (F.col("_upto") > place) & (F.col("_upto") - F.col("_c") <= place))
    found = near.where(hit).collect()  # a value per wanted rank at most
    at = {}
    for (part, place), rank in wanted.items():
        at[rank] = next(r["_x"] for r in found if r["_part"] == part and r["_upto"] - r["_c"] <= place < r["_upto"])
    return [(at[low], at[high], w) for low, high, w in ranks]


# ---- by group ------------------------------------------------------------------------


class RankedValues:
    """The values of a column by group, counted (a row stands for ``count``
    values where that is given), in ranges of (group, value).

    One range partitioning serves any number of groups and ranks: a group of
    any size is spread over ranges, many small groups share one. What a search
    needs of a group is one row per range that it touches."""

    def __init__(self, df: DataFrame, groups: Sequence[str], col: str, count: str | None = None):
        self.groups = list(groups)
        number = F.lit(1).cast("long") if count is None else F.col(count).cast("long")
        values = df.select(*[F.col(g) for g in self.groups], F.col(col).cast("double").alias("_x"), number.alias("_k"))
        values = values.where(F.col("_x").isNotNull() & ~F.isnan("_x"))
        counts = values.groupBy(*self.groups, "_x").agg(F.sum("_k").alias("_c"))
        ranged = counts.repartitionByRange(*[F.col(g) for g in self.groups], F.col("_x"))
        self.ranged = materialize(ranged.withColumn("_part", F.spark_partition_id()))
        within = Window.partitionBy(*self.groups).orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
        parts = self.ranged.groupBy(*self.groups, "_part").agg(F.sum("_c").alias("_n"), F.min("_x").alias("_low"))
        self.parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))

    def sizes(self) -> DataFrame:
        """(groups, n) of every group with a value."""
        return self.parts.groupBy(*self.groups).agg(F.sum("_n").alias("n"))

    def at(self, wanted: DataFrame, rank: str = "rank") -> DataFrame:
        """``wanted`` (groups, ``rank`` from 0, and more) with the value at that
        rank (_x) and how many values are not above it (_upto)."""
        near = wanted.join(self.parts, self.groups).where((F.col(rank) >= F.col("_before")) & (F.col(rank) < F.col("_before") + F.col("_n")))
        near = near.drop("_n", "_low")
        touched = near.select(*self.groups, "_part").distinct()
        upto = F.sum("_c").over(Window.partitionBy("_part", *self.groups).orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
        inside = self.ranged.join(touched, [*self.groups, "_part"], "left_semi").withColumn("_upto", upto)
        found = near.join(inside, [*self.groups, "_part"])
        place = F.col(rank) - F.col("_before")
        found = found.where((place < F.col("_upto")) & (place >= F.col("_upto") - F.col("_c")))
        return found.withColumn("_upto", F.col("_upto") + F.col("_before")).drop("_part", "_before", "_c")


def quantiles_by_group(df: DataFrame, groups: Sequence[str], col: str, probs: dict[str, float]) -> DataFrame:
    """A12 by group: one row per group with its number of values and, for every
    name in ``probs``, the exact type-7 quantile. Groups must not be null."""
    values = RankedValues(df, groups, col)
    sizes = values.sizes()
    listed = F.array(*[F.struct(F.lit(name).alias("_name"), F.lit(p).alias("_p")) for name, p in probs.items()])
    place = sizes.select(*groups, "n", F.inline(listed)).withColumn("_h", (F.col("n") - 1) * F.col("_p"))
    low = F.floor("_h").cast("long")
    ends = F.array(F.struct(low.alias("rank"), (1 - (F.col("_h") - low)).alias("_w")),
                   F.struct(F.least(low + 1, F.col("n") - 1).alias("rank"), (F.col("_h") - low).alias("_w")))
    found = values.at(place.select(*groups, "n", "_name", F.inline(ends)))
    quantile = [F.sum(F.when(F.col("_name") == name, F.col("_w") * F.col("_x"))).alias(name) for name in probs]
    return found.groupBy(*groups, "n").agg(*quantile)


def least_radius(rows: DataFrame, keys: Sequence[str], distance: Column, count: Column, need: Column, buckets: int = 64) -> DataFrame:
    """(keys, radius): for every key the least distance within which at least
    ``need`` of its rows' counts lie. ``rows`` pairs rows with a bounded number
    of keys (say, by a broadcast join) and is never shuffled: a pass counts, per
    key, ``buckets`` slices of the bracket that holds the radius, until the
    slice holds a single distance."""
    rows = rows.select(*keys, distance.alias("_d"), count.alias("_c"), need.alias("_need"))
    first = rows.groupBy(*keys).agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi"), F.max("_need").alias("_need"), F.sum("_c").alias("_all"))
    state = [(*[r[k] for k in keys], r["_lo"], r["_hi"], min(r["_need"], r["_all"])) for r in first.collect()]  # one row per key
    schema = first.select(*keys).schema
    spark, done = rows.sparkSession, []
    key_columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    while state:
        done += [s for s in state if s[-3] == s[-2]]
        open_ = [s for s in state if s[-3] < s[-2]]
        if not open_:
            break
        bracket = spark.createDataFrame(open_, key_columns + ", _lo double, _hi double, _left long")
        near = rows.drop("_need").join(F.broadcast(bracket), list(keys)).where((F.col("_d") >= F.col("_lo")) & (F.col("_d") <= F.col("_hi")))
        slice_ = F.least(F.lit(buckets - 1), F.floor((F.col("_d") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * buckets)).alias("_slice")
        counted = near.groupBy(*keys, slice_).agg(F.sum("_c").alias("_n"), F.min("_d").alias("_a"), F.max("_d").alias("_b"))
        per_key: dict = {}
        for r in counted.orderBy(*keys, "_slice").collect():  # at most ``buckets`` rows per key
            per_key.setdefault(tuple(r[k] for k in keys), []).append((r["_n"], r["_a"], r["_b"]))
        state = []
        for s in open_:
            left = s[-1]
            for n, a, b in per_key[tuple(s[: len(keys)])]:
                if left <= n:
                    state.append((*s[: len(keys)], a, b, left))
                    break
                left -= n
    return spark.createDataFrame([(*s[: len(keys)], s[-3]) for s in done], key_columns + ", radius double")
