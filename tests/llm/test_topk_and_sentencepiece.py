"""Exact top-k against all scores, SentencePiece against its library."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wavecohort.llm import sentencepiece_bpe as S
from wavecohort.llm import topk as K

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    """Every query row's ranks; equal rows count as often as they stand."""
    ok = [(i, [max(-(2**61), min(2**61, math.floor(64 * float(np.float32(x))))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, a in ok:
        if q % every == 0 and a:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(b) == len(a))[:k]
            out.update((q, n + 1, i, max(-K.LONG, min(K.LONG, -s))) for n, (s, i) in enumerate(scores))
    return out


def rows_of(frame):
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("blocks", [(8192, 512), (30, 2)])
def test_top_k_matches_brute_force(spark, blocks):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 6)]) for i in range(150)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(100)]  # copies: ties
    rows += [(400, None), (401, [None] * 6), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, rows[0][1])]
    rows += [(500 + i, [float(x) for x in rng.normal(0, 0.1, 3)]) for i in range(45)] + [(600, []), (601, [])]  # other lengths
    rows += [(20, rows[20][1])] * 3 + [(40, rows[7][1])] * 2 + [(7, rows[7][1])] * 60  # repeated queries, a hot row
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumnsRenamed({"label": "v"}).repartition(5)
    got = rows_of(K.top_k(frame, K.TopKSettings(block_rows=blocks[0], query_rows=blocks[1], survivors=25)))
    assert got == brute(rows)


@pytest.mark.parametrize("power", [3, 6, 12, 17, 30])
def test_large_components(spark, power):
    """Beyond the whole numbers of float64, bounds are only near; scores stay
    exact, and those beyond a long are clamped."""
    rng = np.random.default_rng(power)
    rows = [(i, [float(np.float32(x * 10.0**power)) for x in rng.normal(0, 1, 5)]) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [(300 + i, [0.5, -0.5, 0.25, 0.0, 1.0]) for i in range(30)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    got = K.top_k(frame, K.TopKSettings(block_rows=60, survivors=25))
    if power < 12:
        assert rows_of(got) == brute(rows)
    else:  # clamped scores tie
        assert sorted((r[0], r[1], r[3]) for r in rows_of(got)) == sorted((r[0], r[1], r[3]) for r in brute(rows))


def test_top_k_given_vectors_and_empty(spark, sf):
    frame = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert rows_of(K.top_k(frame)) == brute([(r.vec_id, r.embedding) for r in frame.collect()])
    assert K.top_k(frame.limit(0)).count() == 0
    few = spark.createDataFrame([(20, [1.0], 0), (40, [2.0], 0)], VECTORS)
    assert rows_of(K.top_k(few)) == Counter({(20, 1, 40, 8192): 1, (40, 1, 20, 8192): 1})


def test_bounds_hold_and_reading_stops_early():
    """A clustered block needs only part of the lists."""
    rng = np.random.default_rng(6)
    x = rng.integers(-5, 5, (3000, 8))
    x[:30] += 100
    lists = K.Lists(x, (0.05, 0.5, 1.0), np.float32)
    [(alive, scores)] = K.nra(lists, x[:1], 5, 40, np.zeros((1, 3000), dtype=bool))
    assert len(alive) <= 40 and sorted(scores)[-5:] == sorted(x @ x[0])[-5:]


@pytest.fixture(scope="module")
def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_KEPT = {}


def both():
    if not _KEPT:
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        path = public_tokenizers.path("piece_bpe_32k.model")
        _KEPT.update(own=S.Encoder(path), library=SentencePieceProcessor(model_file=path))
    return _KEPT["own"], _KEPT["library"]


def same(texts):
    own, library = both()
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode(text), repr(text)
        assert S.decode(ids, own.model) == library.decode(ids.tolist()) == text.replace(S.MARK, " "), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "  ", " " * 17, "the", "ing", "\n", S.MARK, "<s>", "<0x0A>", "\x00"]))))
def test_any_text_equals_the_library(parts):
    same(["".join(parts)])


def test_batches_and_long_words():
    rng = random.Random(7)
    texts = ["".join(rng.choice("etaoin shrdlu.,日本é\n") for _ in range(n)) for n in (0, 1, 5, 400, 3000)]
    same([*texts, "x" * 5000, "ab" * 3000, " " * 100, "", *texts])


def test_malformed_ids_decode_like_the_library():
    own, library = both()
    for ids in ([], [0], [1, 2], [3 + 0xE6], [3 + 0xE6, 300], [261, 0, 300], [1, 261], [0, 261], [3 + 0x20, 261]):
        got = S.decode(np.array(ids, dtype=np.int32), own.model)
        assert got.replace("�", "") == library.decode(ids).replace("�", "")


def test_documents(spark, sf, documents, model_path):
    _, library = both()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for r in S.round_trips(docs, model_path).collect():
        assert r.ids == library.encode(r.text) and r.decoded == r.text
    rows = [(1, None), (2, ""), (2, ""), (None, "a b")]
    got = S.round_trips(documents(rows), model_path).collect()
    assert sorted((len(r.ids), r.decoded) for r in got) == [(0, ""), (0, ""), (0, ""), (2, "a b")]


def test_neighbours_and_met_pairs_need_no_search(model_path, monkeypatch):
    """Characters and met pairs are looked up by number: exact where pairs
    share a slot, and only pairs that are new are sorted."""
    model = S.Model(model_path)
    inside = {a + b for p in model.pieces for a, b in zip(p, p[1:])}
    text = "the ▁quick\n日本 Ünï 1,2\x00\U0010ffff▁▁a" + "".join(model.pieces[::97])
    assert model.holds(S.code_points(text)).tolist() == [a + b in inside for a, b in zip(text, text[1:])]
    draw = np.random.default_rng(1)
    left, right = draw.integers(0, 300, (2, 4000))
    monkeypatch.setattr(S, "SLOTS", 1 << 9)
    model.met = np.full(1 << 9, -1, dtype=np.int64)
    want = [model.may_follow(a, b) for a, b in zip(left.tolist(), right.tolist())]
    assert model.follows(left, right).tolist() == want
    assert model.follows(left, right).tolist() == want
    model.follows(left[-1:], right[-1:])
    sorted_, real = [], np.unique
    monkeypatch.setattr(S.np, "unique", lambda x, **k: sorted_.append(len(x)) or real(x, **k))
    model.follows(left[-1:], right[-1:])
    assert not sum(sorted_)
