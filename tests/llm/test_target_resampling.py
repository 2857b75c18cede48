"""Target resampling by brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavecohort.llm import target_resampling as R

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words(text):
    return WORD.findall((text or "").encode().translate(UPPER))


def features(text, max_n=1):
    w = words(text)
    return [b" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, s=R.TargetSettings()):
    """(doc_id, n_features, weight, score, rank) of every (doc_id, text)."""
    counts = [Counter(zlib.crc32(f) % s.buckets for t in texts for f in features(t, s.max_n)) for texts in ([t for _, t in docs], target)]
    raw_all, target_all = (float(sum(c.values())) for c in counts)

    def gain(b):
        r, t = float(counts[0][b]), float(counts[1][b])
        return math.floor(1000 * math.log((t + 1) * (raw_all + s.buckets) / ((r + 1) * (target_all + s.buckets))))

    rows = []
    for doc_id, text in docs:
        found = features(text, s.max_n)
        weight = sum(gain(zlib.crc32(f) % s.buckets) for f in found)
        h = int(hashlib.sha256(f"{s.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(words(text)), len(found), weight, score))
    order = sorted((r for r in rows if r[1] >= s.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    k = s.percent * len(order) // 100
    drawn = [(r[0], r[2], r[3], r[4], i + 1) for i, r in enumerate(order[:k])]
    rest = Counter((r[0], r[2], r[3], r[4]) for r in rows) - Counter(d[:4] for d in drawn)
    return sorted(drawn, key=lambda r: r[4]), rest


def check(spark, docs, target, s=R.TargetSettings(), **more):
    frame = spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], "doc_id long, text string, n_words int")
    for name, value in more.items():
        frame = frame.withColumn(name, F.lit(value))
    got = R.digest(R.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), s)).collect()
    drawn, rest = brute(docs, target, s)
    assert sorted([tuple(r) for r in got if r["rank"]], key=lambda r: r[4]) == drawn
    assert Counter(tuple(r)[:4] for r in got if r["rank"] is None) == rest


SMALL = R.TargetSettings(least_words=2, percent=40, pivots=2)


def test_documents_of_every_kind(spark):
    texts = ["alpha beta gamma", "Alpha BETA déjà 12", "", None, "x", "one,two;three", "日本 語 alpha", "beta " * 5000]
    docs = [(i, texts[i % len(texts)]) for i in range(60)]
    docs += [(None, "alpha beta"), (None, None), (7, "alpha alpha beta"), (7, "alpha alpha beta"), (7, "gamma delta")]
    check(spark, docs, ["alpha beta", None, "", "alpha déjà"], SMALL, score=1, rank="r", _row=2, key=3, weight=0.5, **{"a.b": 1})


def test_repeats_across_the_cut(spark):
    """Copies of one row straddle the k-th place: exactly k are drawn."""
    docs = [(5, "alpha beta gamma")] * 70 + [(i, f"alpha w{i} beta") for i in range(100, 130)]
    for percent in (1, 33, 50, 99, 100):
        check(spark, docs, ["alpha"], R.TargetSettings(least_words=1, percent=percent, pivots=3))


def test_longer_features(spark):
    check(spark, [(i, f"a b c{i % 3} a b") for i in range(20)], ["a b c1"], R.TargetSettings(max_n=3, least_words=2, buckets=97, percent=30))


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "few words")]])
def test_nothing_to_draw(spark, docs):
    check(spark, docs, [])
    check(spark, docs, ["some target"])


def test_kth_smallest(spark):
    draw = np.random.default_rng(3)
    keys = [(int(a), int(b), i) for i, (a, b) in enumerate(draw.integers(0, 4, (300, 2)))]
    rows = spark.createDataFrame(keys, "a long, b long, i long").repartition(5)
    order = [F.col("a"), F.col("b"), F.col("i")]
    for k in (1, 2, 150, 299, 300):
        for pivots in (1, 7, 400):
            if pivots > 1 or k in (1, 150):
                assert R.kth_smallest(rows, order, k, pivots) == sorted(keys)[k - 1]
    with pytest.raises(ValueError):
        R.kth_smallest(rows, order, 301, 50)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_words(text):
    n, found = R.feature_buckets(text, R.TargetSettings())
    assert n == len(words(text)) and found.tolist() == [zlib.crc32(w) % 10_000 for w in words(text)]


def test_words_leave_no_memory_behind():
    """Neither their number nor their length fills a worker's memory."""
    import tracemalloc

    text = lambda i: " ".join(f"{'long' * 50}{i}x{j}" for j in range(100))
    R.feature_buckets(text(0), R.TargetSettings())
    tracemalloc.start()
    try:
        for i in range(1, 201):
            R.feature_buckets(text(i), R.TargetSettings())
        assert tracemalloc.get_traced_memory()[0] < 200_000
    finally:
        tracemalloc.stop()


def test_given_documents(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    check(spark, docs, target)
