"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from wavecohort.llm import simhash as S
from wavecohort.llm.components import components


def brute_print(text):
    words = [w for w in _words((text or "").encode().lower())]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _words(data):
    import re

    return re.findall(rb"[^\x20\x09-\x0D]+", data)


def roots_of(pairs, names):
    root = {n: n for n in names}

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in names}


def brute_components(prints, max_bits):
    items = sorted(prints.items())
    pairs = [(a, b) for i, (a, x) in enumerate(items) for b, y in items[:i] if (x ^ y).bit_count() <= max_bits]
    return roots_of(pairs, prints)


def check(rows, frame, settings=S.SimHashSettings()):
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in S.near_duplicates(frame, settings).collect()}
    prints = {d: brute_print(t) for d, t in rows}
    assert {d: v[0] for d, v in got.items()} == prints
    assert {d: v[1] for d, v in got.items()} == brute_components(prints, settings.max_bits)


def test_fingerprint_matches_brute_force_and_spark_hash(spark):
    for text in [None, "", " \t", "one", "One two", "a b c", "AÄ b c d e", "x " * 50, "\x0b\x0cq\r\nw e r t y" * 9]:
        assert S.fingerprint(text) == brute_print(text)
    [row] = spark.sql("select xxhash64('a b c') as h").collect()
    assert S.fingerprint("A b C") == row.h % (1 << 64)


def test_documents_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(rows, docs)


def test_edge_rows(documents):
    rows = [(1, None), (2, ""), (3, "a b"), (4, "a b"), (9, "A  B"), (5, "c d e f"), (6, " ")]
    check(rows, documents(rows))
    found = S.near_duplicates(documents([(None, "a b"), (4, "a b"), (4, "a b")])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in found) == [(False, 4), (False, 4), (True, None)]
    assert S.near_duplicates(documents([])).count() == 0


def linked_prints(seed, n=400):
    """Distinct fingerprints with chains, stars and far ones."""
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    for _ in range(n // 20):
        base = rng.getrandbits(64)
        for _ in range(20):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            out.add(base)
    return sorted(out)


def test_lists_lose_no_link(spark):
    """Short lists, long lists with a spanning forest, and split lists."""
    prints = linked_prints(3) + [0xABC0000000 + i for i in range(300)]
    for settings in (S.SimHashSettings(), S.SimHashSettings(list_limit=5, small=4), S.SimHashSettings(max_bits=2),
                     S.SimHashSettings(list_limit=20, small=2, max_bits=1)):
        signed = [(int(np.uint64(p).view(np.int64)), i) for i, p in enumerate(prints)]
        nodes = spark.createDataFrame(signed, "fp long, node long")
        edges = S.link_lists(S.postings(nodes, settings), settings)
        for e in edges.collect():
            assert (prints[e.u] ^ prints[e.v]).bit_count() <= settings.max_bits
        got = {i: i for i in range(len(prints))} | {r.node: r.root for r in components(edges).collect()}
        assert got == brute_components(dict(enumerate(prints)), settings.max_bits)


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(200, 200), (149, 300)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    want = roots_of(pairs, {n for p in pairs for n in p})
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(edges.limit(0)).count() == 0


def test_keep_one_keeps_columns_and_one_row_per_component(documents):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (7, "x y z w"), (None, "a b c d"), (8, None), (9, "")]
    frame = documents(rows).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))
    kept = S.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 7), (False, 8), (True, 0)]


CLASHES = ("fp", "node", "id", "own", "_copies", "_c", "_rules", "_bad", "_host", "_known", "least", "root", "component_id", "text_key")


def clashing(frame):
    more = {c: F.lit(i) for i, c in enumerate(CLASHES)} | {"a.b": F.lit("dot"), "m": F.create_map(F.lit("k"), F.col("doc_id"))}
    return frame.withColumns({c: e for c, e in more.items() if c != "a.b"}).withColumn("a.b", more["a.b"])


def test_keep_one_loses_no_unrelated_text(documents):
    """Ten unrelated texts on one doc_id, copies elsewhere, and a doc_id that
    holds most rows."""
    rng = random.Random(8)
    text = lambda: " ".join(str(rng.getrandbits(40)) for _ in range(30))
    ten = [text() for _ in range(10)]
    rows = [(1, t) for t in ten] + [(5, ten[3]), (0, ten[4])] + [(7, ten[9])] * 3 + [(9, "hot text of one doc id")] * 400 + [(None, None)] * 2
    frame = clashing(documents(rows)).repartition(6)
    kept = S.keep_one(frame)
    assert kept.columns == frame.columns and kept.schema["m"].dataType == frame.schema["m"].dataType
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in kept.collect())
    want = [(1, t) for i, t in enumerate(ten) if i != 4] + [(0, ten[4]), (9, "hot text of one doc id"), (-1, ""), (-1, "")]
    assert got == sorted(want)
    assert {r["a.b"] for r in kept.collect()} == {"dot"}


def test_keep_one_of_empty_and_null_tables(documents):
    assert S.keep_one(documents([])).count() == 0
    assert S.keep_one(documents([(None, None)] * 3)).count() == 3
    assert S.keep_one(documents([(i, None) for i in range(5)])).count() == 1
