"""The attention model against naive recomputation, the base by brute force."""

import math
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wavecohort.llm import attention_lm as A

TINY = A.LmSettings(tokenizer="", groups=3, members=4, shared=3, width=3, hidden=5, window=6, stride=2, batch=2)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute_base(rows):
    c = Counter(t for d, text in rows if not held(d) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return sorted(
        ((-1 if d is None else d), held(d), len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), n,
         round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(x)), 6))
        for d, x in rows
    )


def base_of(found):
    rows = ((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    return sorted(rows)


def some_model(settings=TINY, size=30, seed=0):
    draw = np.random.default_rng(seed)
    classes = A.make_classes(draw.integers(0, 50, size), settings)
    p = A.Parameters(settings)
    p.flat[:] = draw.normal(0, 0.7, p.flat.shape)
    return classes, p


def log_softmax(z):
    z = z - z.max()
    return z - math.log(np.exp(z).sum())


def naive_place(full, i, target, classes, p, settings=TINY):
    """log10 probability of ``target`` as the i-th id after those before it in
    ``full``, in float64, over the first window that has the place."""
    w, s = settings.window, settings.stride
    start = 0 if i < w else -(-(i - w + 1) // s) * s
    before = [classes.end if j == 0 else classes.of[full[j - 1]] for j in range(start, i + 1)]
    x = np.array([p.embed[c] + p.place[j] for j, c in enumerate(before)], dtype=float)
    q, k, v = np.split(x @ p.qkv.astype(float), 3, axis=1)
    a = np.exp(q[-1] @ k.T / math.sqrt(settings.width))
    y = x[-1] + (a / a.sum()) @ v @ p.mix
    h = y + np.maximum(y @ p.up + p.up_bias, 0) @ p.down
    group, member = divmod(classes.of[target], settings.members)
    log = log_softmax(h @ p.group + p.group_bias)[group] + log_softmax(h @ p.member[group] + p.member_bias[group])[member]
    return (log + classes.share[target]) / math.log(10)


def naive_log10(ids, classes, p):
    full = [*ids, len(classes.of) - 1]
    return sum(naive_place(full, i, t, classes, p) for i, t in enumerate(full))


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 7, 8, 9, 23])
def test_every_place_is_scored_once(n):
    classes, p = some_model()
    texts = [np.random.default_rng(n + i).integers(0, 29, n) for i in range(3)]
    raw = pd.Series([t.astype("<u2").tobytes() for t in texts])
    got = A.score_ids(raw, A.Model(classes, p.flat), TINY)
    assert got == pytest.approx([naive_log10(t, classes, p) for t in texts], rel=1e-4)


def test_probabilities_add_up_to_one():
    classes, p = some_model()
    for prefix in ([], [3], [1, 2, 3, 4, 5, 6, 7, 8]):
        total = sum(10 ** naive_place(prefix, len(prefix), t, classes, p) for t in range(30))
        assert total == pytest.approx(1, rel=1e-6)


def test_the_untrained_model_is_the_unigram_model():
    counts = np.array([50, 3, 0, 9, 9, 1, 0, 0, 0, 4, 2, 2, 1, 1, 0, 7])
    classes = A.make_classes(counts, TINY)
    p = A.start_parameters(classes, TINY)
    ids = [0, 5, 7, 7, 3, 12, 14]
    [got] = A.score_ids(pd.Series([np.array(ids, dtype="<u2").tobytes()]), A.Model(classes, p.flat), TINY)
    assert got == pytest.approx(sum(math.log10((counts[i] + 1) / (counts + 1).sum()) for i in [*ids, 15]), rel=1e-4)


def test_gradients():
    settings = TINY
    classes, p = some_model()
    draw = np.random.default_rng(5)
    inputs, targets = draw.integers(0, 12, (4, 6)), draw.integers(0, 12, (4, 6))
    counted = draw.random((4, 6)) < 0.7

    def loss(flat):
        q = A.Parameters(settings, flat)
        return -float(A.log_odds(q, A.forward(q, inputs)[-1], targets, counted, settings)[1].mean())

    got = A.gradients(p, inputs, targets, counted, settings).flat
    for i in draw.permutation(len(p.flat))[:60]:
        step = np.zeros_like(p.flat)
        step[i] = 1e-3
        assert got[i] == pytest.approx((loss(p.flat + step) - loss(p.flat - step)) / 2e-3, abs=2e-3)


def test_large_logits_stay_finite():
    _, p = some_model()
    for size in (1e4, -1e4):
        logits, each, total = A.odds(np.full((3, 3), size, dtype=np.float32), p.group, p.group_bias)
        assert np.isfinite(np.log(total)).all() and np.isfinite(each).all()


def test_base_of_every_kind_of_text(spark, tokenizer):
    rows = [(i, f"Alpha beta w{i} the the") for i in range(40)]
    rows += [(None, "the ALPHA"), (None, None), (50, ""), (51, None), (52, " \t "), (53, "é\x85x the\x1cy"), (9, "the"), (9, "the")]
    rows += [(60, "long " * 3000 + "tail")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit("x"), "part": F.lit(1), "a.b": F.lit(2)})
    settings = A.LmSettings(tokenizer=tokenizer, block_documents=7, frequent=5)
    found = A.score_documents(frame, settings).collect()
    assert base_of(found) == brute_base(rows)
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)


@pytest.mark.parametrize("rows", [[], [(3, None)], [(d, "only held out") for d in range(200) if held(d)]])
def test_small_tables(spark, tokenizer, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = A.score_documents(frame, A.LmSettings(tokenizer=tokenizer)).collect()
    assert base_of(found) == brute_base(rows)


def test_given_documents(spark, tokenizer):
    """Base by brute force; training lifts held-out texts far above the
    unigram model that it starts from."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    settings = A.LmSettings(tokenizer=tokenizer)
    found = A.score_documents(docs, settings).collect()
    assert base_of(found) == brute_base(rows)
    untrained = A.score_documents(docs, replace(settings, rate=0.0)).collect()
    total = lambda found: sum(r.score for r in found if r.held_out)
    assert total(found) > 0.85 * total(untrained)


def test_a_step_takes_the_exponentials_of_all_groups_at_once(monkeypatch):
    """Two passes a step, one over the groups' and one over the members' odds."""
    classes, p = some_model()
    seen, real = [], A.exponentials
    monkeypatch.setattr(A, "exponentials", lambda x: seen.append(len(x)) or real(x))
    draw = np.random.default_rng(2)
    inputs, targets = draw.integers(0, 12, (4, 6)), draw.integers(0, 12, (4, 6))
    A.gradients(p, inputs, targets, np.ones((4, 6), dtype=bool), TINY)
    assert seen == [24, 24]


@pytest.mark.parametrize("words, width", [(0, 1), (1, 1), (256, 1), (257, 2), (1 << 16, 2), ((1 << 16) + 1, 3), ((1 << 24) + 1, 4)])
def test_numbers_take_the_bytes_that_their_block_needs(words, width):
    texts = [[], [0, words - 1, 0], [], [words - 1]] if words else [[], []]
    cuts = np.cumsum([0, *map(len, texts)]).tolist()
    raw = A.packed(np.array([n for t in texts for n in t], dtype=np.int64), cuts, words)
    assert [len(r) for r in raw] == [1 + width * len(t) for t in texts]
    assert [A.unpacked(r).tolist() for r in raw] == texts


def test_biases_and_sums_by_class():
    """Biases are part of the matrix products; sums by
    class are the same as one at a time, for odd widths too."""
    draw = np.random.default_rng(3)
    for width in (1, 2, 3, 16):
        where, rows = draw.integers(0, 9, 50), draw.normal(size=(50, width)).astype(np.float32)
        want = np.zeros((9, width))
        np.add.at(want, where, rows)
        assert A.sums_by(where, rows, 9) == pytest.approx(want, abs=1e-4)
    _, p = some_model()
    *_, h = A.forward(p, draw.integers(0, 12, (4, 6)))
    assert (h[:, -1] == 1).all()
    h = h[:3]
    for got, want in zip(A.odds(h, p.group_all), A.odds(h[:, :-1], p.group, p.group_bias)):
        assert got == pytest.approx(want, rel=1e-4)


def test_counts_of_words_take_one_shuffle(spark, tokenizer):
    """Each row of a block and word is shuffled once to be summed and once to go back."""
    rows = [(i, f"alpha beta w{i} the the") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = A.lay_blocks(docs, A.LmSettings(tokenizer=tokenizer, block_documents=7))
    seen, real = [], A.written
    A.written = lambda df, name: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name)
    try:
        answers, totals = A.word_counts(blocks)
    finally:
        A.written = real
    assert [plan.count("Exchange hashpartitioning") for plan in seen] == [1]
    assert answers.groupBy("block", "number").count().where("count > 1").isEmpty()
    training = [t for d, text in rows if not held(d) for t in tokens(text)]
    assert (totals.tokens, totals.distinct) == (len(training), len(set(training)))


def test_scoring_finishes_only_the_places_that_it_scores(monkeypatch):
    """Places that a window shares with the one before are read by attention;
    what is above it is computed once a place."""
    classes, p = some_model()
    raw = pd.Series([np.random.default_rng(i).integers(0, 29, n).astype("<u2").tobytes() for i, n in enumerate((0, 5, 21, 40))])
    seen, real = [], A.forward
    monkeypatch.setattr(A, "forward", lambda *a: seen.append(real(*a)) or seen[-1])
    A.score_ids(raw, A.Model(classes, p.flat), TINY)
    number = A.windows(np.array([1, 6, 22, 41]), TINY.window, TINY.stride)[2]
    assert sum(len(x[-1]) for x in seen) == sum(TINY.window - number)
    some = np.random.default_rng(9).integers(0, 12, (4, 6))
    assert real(p, some, 4)[-1] == pytest.approx(real(p, some)[-1].reshape(4, 6, -1)[:, 4:].reshape(8, -1), rel=1e-5)


def test_words_are_listed_by_bucket_and_ids_are_counted_by_block(spark, tokenizer, monkeypatch):
    """A block has a list of words per bucket, not a row per word, and the
    counts of its training documents' subword ids."""
    monkeypatch.setattr(A, "BUCKETS", 3)
    rows = [(i, f"alpha beta w{i % 9} x{i} the the") for i in range(90)] + [(None, ""), (200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = A.lay_blocks(docs, A.LmSettings(tokenizer=tokenizer, block_documents=7))
    answers, _ = A.word_counts(blocks)
    lists = blocks.where(F.col("part") == A.WORDS)
    assert lists.groupBy("block").count().where("count > 3").isEmpty()
    words = {(r.block, r.number): [bytes(w) for w in r.words] for r in lists.collect()}
    want = Counter(t for d, text in rows if not held(d) for t in tokens(text))
    found = answers.collect()
    assert {(r.block, r.number) for r in found} == set(words) and len(found) == len(words)
    assert all(np.frombuffer(r.c, dtype="<i8").tolist() == [want[w] for w in words[r.block, r.number]] for r in found)
    size = A.word_ids(tokenizer).size + 1
    trained = blocks.where(F.col("part") >= 0).select("ids").collect()
    each = np.bincount(np.concatenate([np.frombuffer(r.ids, dtype=A.id_type(size)) for r in trained]), minlength=size)
    each[-1] += len(trained)
    assert A.id_counts(blocks, size).tolist() == each.tolist()


@pytest.mark.parametrize("limit", [1, 2, 5, 1000])
def test_buckets_are_summed_whole(limit):
    """However batches and limits cut the lists, a word's counts meet."""
    lists = [(b, block, 10 * b, [b"%d" % b, b"%d-%d" % (b, block)], [block, 1]) for b in range(4) for block in range(5)]
    columns = [pa.array(x) for x in zip(*lists)]
    whole = pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "number", "words", "counts"])
    for step in (1, 3, 20):
        batches = [whole.slice(a, step) for a in range(0, len(whole), step)]
        out = pa.Table.from_batches(A.summed(iter([whole.slice(0, 0), *batches]), limit)).to_pylist()
        assert [(r["block"], r["number"], np.frombuffer(r["c"], dtype="<i8").tolist()) for r in out] == [(b, n, [10, 1]) for _, b, n, _, _ in lists]
        assert (sum(r["n"] for r in out), sum(r["v"] for r in out)) == (4 * 15, 4 * 6)
