"""Importance resampling towards a target distribution, drawn by distributed
quickselect.

Every run of 1 to ``max_n`` consecutive words is a feature, hashed into one of
``buckets`` buckets by CRC-32. The bucket counts of all raw texts and of all
target texts give a whole-number gain per bucket; a text's weight is the sum of
its features' gains, looked up in one array. Weight plus a Gumbel draw fixed by
the doc_id is the score, and the highest scores of the long enough texts are
drawn without replacement.

The k-th best row is found without sorting the table: each round takes
``pivots`` random rows of the open interval, counts in one pass how many rows
lie before, at and between them, and keeps the interval (or the pivot) that
holds the k-th. Keys are composite (score, doc_id, n_features, row number), so
no two are equal, counts are exact and rows that tie or repeat are split like
any others. Rounds grow with the logarithm of the row count; a round brings at
most 2 * ``pivots`` + 1 counts to the driver. Only the winners are then sorted,
by range, and ranked.

Defined results: a null or empty text has no features and weight 0; a null
doc_id draws like the text ``null`` and comes after all others at equal scores;
rows that repeat a doc_id share their draw, and of rows equal in score and
doc_id the one with fewer features comes first; very long texts count whole;
an empty target leaves the smoothing's gains; an empty table gives an empty
result. Other columns of the documents are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe_ids import blocks
from .common import text_batches, written

# Words are runs of ASCII digits, letters and every byte of other characters.
# Lower-casing and cutting are one byte translation: A-Z to a-z, bytes that
# stand in no word to a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


@dataclass(frozen=True)
class TargetSettings:
    max_n: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024
    pivots: int = 48  # random keys a round


def feature_buckets(text: str | None, settings: TargetSettings) -> tuple[int, np.ndarray]:
    """(number of words, the bucket of every feature). Hashing a word takes
    less time than looking it up among those met before, and no memory."""
    words = (text or "").encode().translate(WORD_BYTES).split()
    found = list(map(zlib.crc32, words))
    for n in range(2, settings.max_n + 1):
        found += [zlib.crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
    return len(words), np.array(found, dtype=np.int64) % settings.buckets


def bucket_counts(raw: DataFrame, target: DataFrame, settings: TargetSettings) -> DataFrame:
    """(bucket, raw, target) over every row of both tables; a task sends one
    row per bucket at most."""
    buckets = settings.buckets

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, buckets), dtype=np.int64)
        for pdf in batches:
            for side in (0, 1):
                texts = [t or "" for t in pdf["text"][pdf["side"] == side]]
                for a, b in blocks(texts):
                    found = [feature_buckets(t, settings)[1] for t in texts[a:b]]
                    sums[side] += np.bincount(np.concatenate(found), minlength=buckets)
        seen = np.flatnonzero(sums.sum(axis=0))
        yield pd.DataFrame({"bucket": seen, "raw": sums[0, seen], "target": sums[1, seen]})

    texts = raw.select("text", F.lit(0).alias("side")).union(target.select("text", F.lit(1).alias("side")))
    each = texts.mapInPandas(count, "bucket long, raw long, target long")
    return each.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def gains(counts: DataFrame, settings: TargetSettings) -> np.ndarray:
    """The gain of every bucket; at most ``buckets`` rows reach the driver."""
    s, t = np.zeros(settings.buckets), np.zeros(settings.buckets)
    for row in counts.collect():  # at most ``buckets`` rows
        s[row["bucket"]], t[row["bucket"]] = row["raw"], row["target"]
    ratio = (t + 1) * (s.sum() + settings.buckets) / ((s + 1) * (t.sum() + settings.buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def gumbel_units(doc_id: Column, seed: int) -> Column:
    """floor(1000 * a standard Gumbel draw), fixed by the doc_id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256), 1, 8)
    unit = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(unit))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, settings: TargetSettings) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def score(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words, found = feature_buckets(text, settings)
            rows.append((words, len(found), int(gain[found].sum())))
        return pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), score("text").alias("w")).select("doc_id", "w.*")
    return rows.withColumn("score", F.col("weight") + gumbel_units(F.col("doc_id"), settings.seed))


# ---- distributed quickselect ------------------------------------------------------

def _key(order: list[Column]) -> Column:
    return F.struct(*[c.cast("long").alias(f"k{i}") for i, c in enumerate(order)])


def _literal(key: tuple[int, ...]) -> Column:
    return F.struct(*[F.lit(v).cast("long").alias(f"k{i}") for i, v in enumerate(key)])


def kth_smallest(rows: DataFrame, order: list[Column], k: int, pivots: int, seed: int = 0) -> tuple[int, ...]:
    """The k-th smallest (from 1) composite key of ``rows``; ``order`` are
    long columns without nulls whose combinations are unique.

    Each round's three-way counts (before, at, after every pivot) are exact,
    so the interval that is kept holds the k-th key for certain."""
    key = _key(order)
    low = high = None
    step = 0
    while True:
        step += 1
        inside = rows
        for bound, beyond in ((low, True), (high, False)):
            if bound is not None:
                # the first part alone may be pushed down to the file
                inside = inside.where((order[0] >= bound[0]) if beyond else (order[0] <= bound[0]))
                inside = inside.where((key > _literal(bound)) if beyond else (key < _literal(bound)))
        draw = F.xxhash64(*order, F.lit(seed), F.lit(step))
        drawn = inside.select(key.alias("key")).orderBy(draw, "key").limit(pivots).collect()  # at most ``pivots``
        points = sorted(tuple(r["key"]) for r in drawn)
        if not points:
            raise ValueError("k is larger than the number of rows")
        listed = F.array(*[_literal(p) for p in points])
        before = F.size(F.filter(listed, lambda p: p < F.col("key")))
        at = F.array_contains(listed, F.col("key"))
        counts = inside.select(key.alias("key")).groupBy(before.alias("before"), at.alias("at")).count().collect()  # 2 * pivots + 1
        found = {(r["before"], r["at"]): r["count"] for r in counts}
        for i in range(len(points) + 1):
            between = found.get((i, False), 0)
            if k <= between:
                low, high = points[i - 1] if i else low, points[i] if i < len(points) else high
                break
            k -= between
            if i < len(points):
                if k <= found.get((i, True), 0):
                    return points[i]
                k -= found.get((i, True), 0)
        else:
            raise ValueError("k is larger than the number of rows")


def range_ranks(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with rank (1, 2, 3, ... by the unique ``order``): sorted by
    range, so that no task holds more than its range."""
    laid = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "winners")
    sizes = laid.groupBy("_part").agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy(*order)
    ranked = laid.withColumn("_place", F.row_number().over(within)).join(starts, "_part")
    return ranked.withColumn("rank", (F.col("_place") + F.col("_before")).cast("long")).drop("_part", "_place", "_before")


def resample(docs: DataFrame, target: DataFrame, settings: TargetSettings = TargetSettings()) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document;
    ``target`` has a text column. Documents that are not drawn have no rank."""
    text_batches(docs.sparkSession)
    gain = gains(bucket_counts(docs, target, settings), settings)
    scored = weigh(docs, gain, settings).withColumn("_row", F.monotonically_increasing_id())
    scored = written(scored, "target-scores")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    may = F.col("n_words") >= settings.least_words
    k = settings.percent * scored.where(may).count() // 100
    if not k:
        return scored.select(*columns, unranked)
    # descending score, ascending doc_id (null last), fewer features, row
    order = [-F.col("score"), F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.col("n_features"), F.col("_row")]
    cut = kth_smallest(scored.where(may), order, k, settings.pivots, settings.seed)
    drawn = may & (_key(order) <= _literal(cut))
    winners = range_ranks(scored.where(drawn), order).select(*columns, "rank")
    return winners.unionByName(scored.where(~drawn).select(*columns, unranked))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# DuckDB SQL for ``digest(resample(documents, benchmark))``. A word's CRC-32 is
# taken byte by byte over its table, which is made by its rule.
SQL = r"""
with crc_table as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(cast(i as bigint), [cast(0 as bigint) for _ in range(8)]),
    lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
texts as (
  select 0 as side, row_number() over () as rid, doc_id, text from documents
  union all select 1, null, null, text from benchmark),
words as (
  select side, rid, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
  from texts),
buckets as (
  select w, xor(list_reduce(
      list_prepend(cast(4294967295 as bigint),
        list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda h: cast('0x' || h as bigint))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select distinct w from words), crc_table),
hits as (select side, rid, bucket, count(*) as n from words join buckets using (w) group by all),
totals as (
  select cast(coalesce(sum(n) filter (where side = 0), 0) as double) as s_all,
    cast(coalesce(sum(n) filter (where side = 1), 0) as double) as t_all from hits),
gains as (
  select bucket, cast(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) as bigint) as gain
  from (select bucket, cast(coalesce(sum(n) filter (where side = 0), 0) as double) as s,
      cast(coalesce(sum(n) filter (where side = 1), 0) as double) as t from hits group by bucket), totals),
weights as (
  select rid, cast(sum(n) as bigint) as n_features, cast(sum(n * gain) as bigint) as weight
  from hits join gains using (bucket) where side = 0 group by rid),
scored as (
  select rid, doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
      (cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), 'null')), 1, 8) as bigint) + 0.5::double) / 4294967296.0::double
    ))) as bigint) as score
  from texts left join weights using (rid) where side = 0),
ranked as (
  select rid, row_number() over (order by score desc, doc_id nulls last, n_features, rid) as place,
    count(*) over () as eligible
  from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * eligible // 100 then place end as rank
from scored left join ranked using (rid)
"""
