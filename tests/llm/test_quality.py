"""Quality rules, the importance classifier and the license scan."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wavecohort.llm import importance as I
from wavecohort.llm import licenses as L
from wavecohort.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_repeats(words, width=8):
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    counts = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(width)})


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), brute_repeats(words))


def test_counts_match_brute_force(spark, sf):
    rng = np.random.default_rng(2)
    texts = [None, "", " \n\t", "é b\x0bc\x1fd", "a\na\n \n \na", "# * $ % & | < >", "w " * 9, "w " * 8]
    texts += [" ".join(rng.choice(list("abc"), size=n)) for n in range(1, 80)]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for t in texts:
        assert Q.text_counts(t) == brute_counts(t)


def test_host_verdicts(documents):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "too short", "bad") for i in range(40)] + [(100, good, "bad"), (101, good, None), (102, None, None)]
    rows += [(200 + i, good, f"host{i % 4}") for i in range(200)]
    got = {r.doc_id: r for r in Q.document_verdicts(documents(rows)).collect()}
    assert got[100].host_failed and not got[100].base_failed and not got[100].kept
    assert not got[101].host_failed and got[101].kept and got[102].base_failed
    assert all(got[200 + i].kept for i in range(200))
    frame = documents(rows).withColumn("kept", F.lit(1)).withColumn("n_words", F.lit("x"))
    kept = Q.keep_good(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}
    assert Q.document_verdicts(documents([])).count() == 0


def test_kth_largest_matches_sorting(spark):
    rng = np.random.default_rng(3)
    values = [int(x) for x in rng.integers(-(2**60), 2**60, size=400)] + [5] * 30 + [0, -1, 2**61, -(2**61)]
    frame = spark.createDataFrame([(v,) for v in values], "x long")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 17, 215, 220, len(values)):
        assert I.kth_largest(frame, "x", k) == ordered[k - 1]


def brute_weights(docs, fit, settings):
    raw = Counter(b for t in docs.values() for b in I.ngram_buckets(t, settings.buckets).tolist())
    target = Counter(b for d in fit for b in I.ngram_buckets(docs[d], settings.buckets).tolist())
    n, m, size = sum(raw.values()), sum(target.values()), settings.buckets
    out = {}
    for d, t in docs.items():
        total, found = 0.0, I.ngram_buckets(t, size).tolist()
        for b in found:
            p = (raw[b] + 1) / (n + size)
            total += math.log((target[b] + size * p) / (m + size)) - math.log(p)
        out[d] = settings.typical_ngrams * total / (len(found) + settings.prior_ngrams)
    return out


def test_weights_and_selection_match_brute_force(spark, sf):
    settings = I.ResampleSettings(buckets=1 << 12)
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    parts = {r.doc_id: r.part for r in I.labelled_good(labels, settings).collect()}
    want = brute_weights(texts, [d for d, p in parts.items() if p == "fit" and d in texts], settings)
    got = {r.doc_id: r for r in I.resample(docs, labels, settings).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[d].weight - w) < 1e-6 for d, w in want.items())
    held = sorted(want[d] for d, p in parts.items() if p == "held_out" and d in want)
    k = sum(w >= held[int(settings.miss * len(held))] - 1e-9 for w in want.values())
    best = sorted(got.values(), key=lambda r: -r.gumbel_key)[:k]
    assert {r.doc_id for r in best} == {d for d, r in got.items() if r.kept}


def test_held_out_accuracy(spark):
    """Good documents stay, documents labelled bad mostly go."""
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in I.resample(docs, labels).where("kept").collect()}
    known = [(r.doc_id, r.quality) for r in labels.join(docs, "doc_id").collect()]
    good, bad = [d for d, q in known if q == 1], [d for d, q in known if q == 0]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    assert sum(d in kept for d in bad) <= 0.3 * len(bad)


def test_selection_edges(documents, spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [(None, "a b"), (1, None), (2, ""), (3, "x y z"), (3, "x y z"), (4, "w " * 5000)]
    assert I.resample(documents(rows), labels.limit(0)).where("kept").count() == len(rows)
    frame = documents(rows).withColumn("weight", F.lit("x")).withColumn("kept", F.lit(0))
    assert I.keep_selected(frame, labels).columns == frame.columns
    assert I.resample(documents([]), labels).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_licenses_match_exact_containment(spark, documents):
    templates = [shingle_set(t) for _, t in L.TEMPLATES]
    long = L.TEMPLATES[2][1].split()
    rows = [(1, None), (2, ""), (3, "MIT"), (4, "Released under the MIT License."), (5, "noise " * 70 + L.TEMPLATES[4][1] + " tail" * 90)]
    rows += [(6, " ".join(long[:40] + ["CHANGED"] + long[41:])), (7, " ".join(long[: len(long) // 2])), (8, L.TEMPLATES[7][1] + "\n" + L.TEMPLATES[3][1])]
    rows += [(100 + i, "lorem ipsum " * (i * 7) + t.upper() + " dolor sit amet" * i) for i, (_, t) in enumerate(L.TEMPLATES)]
    rows += [(4, "Released under the MIT License.")]
    got = Counter((r.doc_id, r.template, round(r.containment, 6)) for r in L.scan(documents(rows)).collect())
    want = Counter()
    for d, t in rows:
        s = shingle_set(t)
        for i, x in enumerate(templates):
            if len(x & s) / len(x) >= 0.8:
                want[d, i, round(len(x & s) / len(x), 6)] += 1
    assert got == want
    assert L.scan(documents([])).count() == 0


def test_scan_plan_is_native(spark, documents):
    plan = L.scan(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert all(L.least_collision(n, L.ScanSettings()) >= 0.99 for n in range(1, 200))


def test_a_labelled_document_counts_once_however_often_it_is_repeated(spark, documents):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice("abcdefghij"[: 4 + i % 6]) for _ in range(30 + i % 50))) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    settings = I.ResampleSettings(buckets=1 << 8, miss=0.2)
    parts = {r.doc_id: r.part for r in I.labelled_good(labels, settings).collect()}
    for part in ("fit", "held_out"):
        hot = min(d for d, p in parts.items() if p == part)
        frame = documents(rows + [rows[hot]] * 400)
        found = I.resample(frame, labels, settings).collect()
        got = {r.doc_id: r for r in found}
        texts = dict(rows)
        raw = Counter(b for d, t in rows + [rows[hot]] * 400 for b in I.ngram_buckets(t, settings.buckets).tolist())
        target = Counter(b for d, p in parts.items() if p == "fit" for b in I.ngram_buckets(texts[d], settings.buckets).tolist())
        n, m, size = sum(raw.values()), sum(target.values()), settings.buckets
        want = {}
        for d, t in rows:
            grams, total = I.ngram_buckets(t, size).tolist(), 0.0
            for b in grams:
                p = (raw[b] + 1) / (n + size)
                total += math.log((target[b] + size * p) / (m + size)) - math.log(p)
            want[d] = settings.typical_ngrams * total / (len(grams) + settings.prior_ngrams)
        assert all(abs(got[d].weight - w) < 1e-6 for d, w in want.items())
        held = sorted(want[d] for d, p in parts.items() if p == "held_out")
        level = held[int(settings.miss * len(held))] - 1e-9
        k = sum((401 if d == hot else 1) for d, w in want.items() if w >= level)
        best = sorted(found, key=lambda r: -r.gumbel_key)
        cut = best[k - 1].gumbel_key  # an entry that stands at the cut stays whole
        assert sum(r.kept for r in found) == sum(r.gumbel_key >= cut for r in found)
        labelled = I.labelled_texts(frame.select("doc_id", "text"), I.labelled_good(labels, settings))
        assert labelled.count() == len(parts)


def test_own_columns_of_any_name_stay(documents):
    from test_simhash import clashing

    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good if i % 3 else "few", f"h{i % 2}") for i in range(30)] + [(None, good, None)]
    frame = clashing(documents(rows))
    kept = Q.keep_good(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted([i for i in range(30) if i % 3] + [-1])
    assert {(r["_c"], r["_bad"], r["a.b"]) for r in kept.collect()} == {(5, 7, "dot")}
