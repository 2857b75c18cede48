"""Sharding by jump consistent hashing.

``jump_shard`` is the published jump consistent hash (Lamping and Veach): the
key seeds a linear congruential generator whose draws are the shard counts at
which the key would move, so the shard of a key under ``n`` shards is the last
such jump below ``n``. No ring table; one more shard takes rows only into
itself. Everything here is Column expressions.

Defined results: a null key hashes as -1; a null text has size ``overhead``
and the CRC-32 of the empty string; repeated rows get the same shard and
different slots; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

# Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
SCALE = 1 << 31

_U32 = (1 << 32) - 1


def _next_state(state: Column) -> Column:
    """state * MULTIPLIER + 1 modulo 2**64, on signed longs, by halves: each
    product of 32-bit halves is split again so that nothing overflows."""
    lo, hi = state.bitwiseAND(F.lit(_U32)), F.shiftrightunsigned(state, 32)
    m_lo, m_hi = MULTIPLIER & _U32, MULTIPLIER >> 32
    # 32 x 32 bits by 16-bit pieces of the constant: every term is below 2**49
    def times(part: Column, constant: int):
        low, high = part * (constant & 0xFFFF), part * (constant >> 16)
        return low, high

    a, b = times(lo, m_lo)
    # low word of lo * m_lo + 1, and what it carries into the high word
    first = a + F.shiftleft(b.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    low = first.bitwiseAND(F.lit(_U32))
    carry = F.shiftrightunsigned(first, 32) + F.shiftrightunsigned(b, 16)
    c, d = times(lo, m_hi)
    e, f = times(hi, m_lo)
    high = carry + c + F.shiftleft(d.bitwiseAND(F.lit(0xFFFF)), 16) + e + F.shiftleft(f.bitwiseAND(F.lit(0xFFFF)), 16)
    return F.shiftleft(high.bitwiseAND(F.lit(_U32)), 32).bitwiseOR(low)


def _jumps(limit: int) -> int:
    """Draws after which a key has passed ``limit`` shards but with a chance
    below 1e-30: each draw multiplies the shard count by 1/u, u uniform, so
    the chance of fewer than that after k draws is a Poisson tail."""
    mean, k, tail = math.log(limit + 1), 0, 1.0
    while tail > 1e-30:
        k += 1
        tail = math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) * 2
    return k + 4


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (int, from 0) of a long key under ``shards`` shards.

    The loop is an ``aggregate`` over enough steps; a key that has passed
    ``shards`` keeps its state. One shard needs no draw."""
    if shards == 1:
        return F.lit(0)
    start = F.struct(
        F.coalesce(key.cast("long"), F.lit(-1)).alias("state"), F.lit(-1).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("next"),
    )

    def step(acc, _):
        state = _next_state(acc["state"])
        draw = F.shiftrightunsigned(state, 33) + F.lit(1)
        jump = F.floor((acc["next"] + F.lit(1)).cast("double") * (F.lit(float(SCALE)) / draw.cast("double")))
        moved = F.struct(state.alias("state"), acc["next"].alias("shard"), jump.cast("long").alias("next"))
        return F.when(acc["next"] < shards, moved).otherwise(acc)

    steps = F.array(*[F.lit(i) for i in range(_jumps(shards))])
    return F.aggregate(steps, start, step)["shard"].cast("int")


def assign_shards(
    rows: DataFrame, key: str, shards: int, order: tuple[str, ...], rows_per_bucket: int = 100_000
) -> DataFrame:
    """``rows`` with ``shard``, ``grown_shard`` (with one more shard) and
    ``slot``, gapless from 0 within each shard.

    Slots take no shard through one task: rows are dealt to buckets by a hash
    of the ``order`` columns (about ``rows_per_bucket`` rows a bucket), each
    (shard, bucket) is counted with partial sums, a running sum over those
    counts gives each bucket its first slot, and rows are numbered within
    their bucket by ``order``. Rows equal in all ``order`` columns, which would
    share a bucket, are spread by a number that ``written`` fixes.
    """
    base = written(
        rows.withColumn("shard", jump_shard(F.col(key), shards))
        .withColumn("grown_shard", jump_shard(F.col(key), shards + 1))
        .withColumn("_row", F.monotonically_increasing_id()),
        "shards",
    )
    total = base.count()
    buckets = max(1, math.ceil(total / rows_per_bucket))
    base = base.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    counts = base.groupBy("shard", "_bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("shard", "_bucket").orderBy(*order, "_row")
    return (
        base.withColumn("_n", F.row_number().over(within))
        .join(first, ["shard", "_bucket"])
        .withColumn("slot", (F.col("_first") + F.col("_n") - 1).cast("long"))
        .drop("_n", "_first", "_bucket", "_row")
    )


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus ``overhead``), text_crc32,
    law, shard, slot, grown_shard of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    out = assign_shards(rows, "doc_id", shards, ("doc_id", "size", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


# DuckDB SQL for ``shard_documents`` over documents. The CRC-32 is taken byte by
# byte over its table, which is made by its rule; slots count in order of the
# rows, as they do in a table of one bucket.
SQL = """
with recursive d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
crc_table as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(cast(i as bigint), [cast(0 as bigint) for _ in range(8)]),
    lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
sized as (
  select rid, doc_id, cast(octet_length(encode(text)) + 16 as bigint) as size,
    xor(list_reduce(
      list_prepend(cast(4294967295 as bigint),
        list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: cast('0x' || h as bigint))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32
  from d, crc_table),
jump as (
  select rid, n, case when coalesce(doc_id, -1) < 0 then cast(coalesce(doc_id, -1) as hugeint) + 18446744073709551616
      else cast(doc_id as hugeint) end as k, cast(-1 as bigint) as shard, cast(0 as bigint) as next
  from d, (values (40), (41)) t(n)
  union all
  select rid, n, k2, next, cast(floor((next + 1) * (2147483648.0::double / cast(k2 // 8589934592 + 1 as double))) as bigint)
  from (select *, (k * 2862933555777941757 + 1) % 18446744073709551616 as k2 from jump where next < n)),
placed as (select rid, max(case when n = 40 then shard end) as shard, max(case when n = 41 then shard end) as grown_shard from jump group by rid)
select doc_id, size, text_crc32, 'key' as law, cast(shard as integer) as shard,
  cast(row_number() over (partition by shard order by doc_id nulls first, size, text_crc32) - 1 as bigint) as slot,
  cast(grown_shard as integer) as grown_shard
from sized join placed using (rid)
"""
