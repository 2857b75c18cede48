"""Centroid clustering by brute force in Python's whole numbers."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wavecohort.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def squared(x, c):
    return sum((a - b) ** 2 for a, b in zip(x, c))


def brute(rows, s):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == s.dims and all(a is not None and math.isfinite(a) for a in x):
            kept.append((vec_id, [max(-C.CLAMP, min(C.CLAMP, math.floor(s.scale * a) if math.isfinite(s.scale * a) else int(math.copysign(C.CLAMP, a)))) for a in x]))
    name = lambda i: hashlib.sha256(f"{s.seed}:{'null' if i is None else i}".encode()).hexdigest()
    centers = [x for _, x in sorted(kept, key=lambda r: (name(r[0]), r[1]))[: s.clusters]]
    for turn in range(s.rounds + 1):
        found = [min((squared(x, c), j) for j, c in enumerate(centers)) for _, x in kept]
        if turn == s.rounds:
            break
        for j in range(len(centers)):
            mine = [x for (_, x), (_, f) in zip(kept, found) if f == j]
            if mine:
                centers[j] = [sum(col) // len(mine) for col in zip(*mine)]
    inertia = Counter()
    for d, j in found:
        inertia[j] += d
    top = lambda d: min(d, C.LARGEST)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    total = top(sum(inertia.values()))
    return Counter((i, j, top(d), top(inertia[j]), total, sha[j]) for (i, _), (d, j) in zip(kept, found))


def check(spark, rows, s):
    frame = spark.createDataFrame([(i, x, "own", 1) for i, x in rows], SCHEMA).repartition(3)
    assert Counter(tuple(r) for r in C.cluster(frame, s).collect()) == brute(rows, s)


SMALL = C.CentroidSettings(clusters=5, rounds=3, dims=4, block=7)


def test_small_tables(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=4).round(2).tolist()) for i in range(60)]
    rows += [(7, [0.5, 0.5, 0.5, 0.5])] * 40  # a hot vector
    rows += [(None, [0.1] * 4), (None, [0.1] * 4), (90, None), (91, []), (92, [1.0] * 3), (93, [1.0] * 5)]
    rows += [(94, [1.0, None, 0.0, 0.0]), (95, [1.0, float("nan"), 0.0, 0.0]), (96, [1.0, float("inf"), 0.0, 0.0])]
    check(spark, rows, SMALL)


def test_ties_and_equal_centroids(spark):
    rows = [(i, [float(a), float(b), 0.0, 0.0]) for i, (a, b) in enumerate([(x, y) for x in range(4) for y in range(4)] * 3)]
    check(spark, rows, SMALL)
    check(spark, [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(20)], SMALL)


def test_large_components(spark):
    rows = [(i, [10.0 ** (i % 20), -(2.0**i), 1.0, 0.0]) for i in range(30)] + [(99, [1e300, -1e300, 0.0, 0.0])]
    check(spark, rows, SMALL)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(3, [0.1, 0.2, 0.3, 0.4])], [(i, [float(i)] * 4) for i in range(3)]])
def test_fewer_vectors_than_clusters(spark, rows):
    check(spark, rows, SMALL)


WHOLE = st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(WHOLE, WHOLE, st.sampled_from([np.int64, object]))
def test_nearest(xs, cs, kind):
    cluster, distance, steps = C.nearest(np.array(xs, dtype=kind), C.SortedLists(np.array(cs, dtype=kind)))
    want = [min((squared(x, c), j) for j, c in enumerate(cs)) for x in xs]
    assert list(zip(distance.tolist(), cluster.tolist())) == want
    assert (steps <= len(cs)).all()


def test_walks_stop_early():
    """Around tight groups the frontier passes the best distance long before
    the lists end."""
    draw = np.random.default_rng(2)
    centers = draw.integers(-2000, 2000, (40, 16))
    x = centers[draw.integers(0, 40, 500)] + draw.integers(-20, 20, (500, 16))
    _, _, steps = C.nearest(x, C.SortedLists(centers))
    assert steps.mean() < 4


def test_given_vectors(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    frame = spark.read.parquet(f"{sf}/embeddings.parquet")
    s = C.CentroidSettings()
    got = Counter(tuple(r) for r in C.cluster(frame, s).collect())
    assert got == brute([(i, None if x is None else [float(np.float32(a)) for a in x]) for i, x in rows], s)
