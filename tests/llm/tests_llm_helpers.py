"""The pipeline's filters by brute force over collected rows."""

from collections import defaultdict

from test_quality import brute_counts, brute_weights
from test_simhash import brute_components, brute_print

from wavecohort.llm import importance as I


def rules(rows):
    failed = {}
    hosts = defaultdict(list)
    for r in rows:
        n, _, _, _, repeats = brute_counts(r.text)
        failed[r.doc_id] = n < 20 or 100 * repeats > 30 * n
        hosts[r.source].append(failed[r.doc_id])
    total, docs = sum(map(sum, hosts.values())), sum(map(len, hosts.values()))
    mean = total / docs
    rates = [sum(f) / len(f) for f in hosts.values()]
    average = sum(rates) / len(rates)
    variance = sum((x - average) ** 2 for x in rates) / len(rates)
    strength = 0 if mean in (0, 1) else 1e6 if not variance else min(1e6, max(0, mean * (1 - mean) / variance - 1))
    bad = {h for h, f in hosts.items() if (sum(f) + strength * mean) / (len(f) + strength) > 0.5}
    return [r for r in rows if not failed[r.doc_id] and r.source not in bad]


def classifier(rows, labels, spark):
    settings = I.ResampleSettings()
    texts = {r.doc_id: r.text for r in rows}
    parts = {r.doc_id: r.part for r in I.labelled_good(labels, settings).collect()}
    weights = brute_weights(texts, [d for d, p in parts.items() if p == "fit" and d in texts], settings)
    held = sorted(weights[d] for d, p in parts.items() if p == "held_out" and d in weights)
    k = sum(w >= held[int(settings.miss * len(held))] - 1e-9 for w in weights.values())
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(list(weights.items()), "doc_id long, weight double")
    noised = frame.select("doc_id", (F.col("weight") + I.gumbel(F.col("doc_id"), settings.seed)).alias("x")).collect()
    kept = {r.doc_id for r in sorted(noised, key=lambda r: -r.x)[:k]}
    return [r for r in rows if r.doc_id in kept]


def brute_pipeline(docs, labels):
    rows = classifier(rules(docs.collect()), labels, docs.sparkSession)
    roots = brute_components({r.doc_id: brute_print(r.text) for r in rows}, 3)
    return sorted(d for d, root in roots.items() if d == root)
