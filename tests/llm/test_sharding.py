"""Jump consistent hashing against a direct transcription of its definition."""

import random
import zlib

from pyspark.sql import functions as F

from wavecohort.llm import sharding as S


def jump(key, shards):
    """The shard by its recurrence, on Python integers."""
    state, shard, following = key % (1 << 64), -1, 0
    while following < shards:
        shard = following
        state = (state * S.MULTIPLIER + 1) % (1 << 64)
        following = int((shard + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return shard


def test_jump_shard(spark):
    rng = random.Random(1)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(500)] + list(range(500)) + [-1, (1 << 63) - 1, -(1 << 63)]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 40, 41, 5000):
        got = {r.k: r.s for r in frame.select("k", S.jump_shard(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def check(rows, out):
    seen = {}
    for r in out:
        text = r.text_crc32
        assert r.law == "key" and r.shard == jump(-1 if r.doc_id is None else r.doc_id, 40)
        assert r.grown_shard in (r.shard, 40)
        seen.setdefault(r.shard, []).append(r.slot)
        assert text >= 0
    assert all(sorted(s) == list(range(len(s))) for s in seen.values())
    want = sorted((d is None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in out) == want


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], S.shard_documents(docs).collect())


def test_edge_rows_and_many_buckets(documents):
    rows = [(None, "x"), (1, None), (2, ""), (3, "é" * 1000)] + [(7, "same")] * 300 + [(i, "t") for i in range(10, 200)]
    check(rows, S.shard_documents(documents(rows).withColumn("shard", F.lit("x"))).collect())
    spread = documents(rows).select("doc_id", F.lit(1).cast("long").alias("size"))
    out = S.assign_shards(spread, "doc_id", 3, ("doc_id",), rows_per_bucket=20).collect()
    for shard in range(3):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert S.shard_documents(documents([])).count() == 0
