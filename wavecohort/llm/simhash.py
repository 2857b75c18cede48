"""SimHash near-duplicates by a byte-position inverted index.

A fingerprint has 8 bytes; two fingerprints that differ in at most d bits
(d <= 7) differ in at most d bytes, so they share at least 8 - d positional
bytes. Then one half of the 8 positions holds at least k = ceil((8 - d) / 2)
shared ones, and the pair meets in a posting list addressed by some k
positional bytes of one half (d = 3: 8 lists a fingerprint, 24-bit
addresses). Within a list the shared positional bytes of a pair are tallied,
pairs that reach 8 - d are retained, and their bits are compared.

Lists hold distinct fingerprints only, so copies never meet. A list longer
than ``list_limit`` is split by addresses of all 8 - d shared bytes; what is
left free there are d bytes, so such a list is bounded by 2 ** (8 * d)
fingerprints, and none is dropped. Lists of up to ``small`` fingerprints are
compared pair by pair, longer ones emit a spanning forest: a breadth-first
walk that meets each fingerprint once, so edges stay linear in the list.

Defined results: a text without words, empty or null, has fingerprint zero
and links like any other; rows with a null doc_id get a fingerprint and no
component; repeated rows share a component; a doc_id that stands on several
texts links nothing by itself; of equal doc_ids ``keep_one`` takes the text of
the smallest hash; very long texts count whole; an empty table gives an empty
result. Own columns may have any names and types.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches, written
from .components import components


@dataclass(frozen=True)
class SimHashSettings:
    shingle_words: int = 3
    max_bits: int = 3
    seed: int = 42
    list_limit: int = 4096
    small: int = 32


_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words' shingles, unsigned."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    last = ends[shingle_words - 1 :].tolist() or [len(joined)]
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    hashes = np.fromiter(
        [xxh64_intdigest(joined[a:b], seed) for a, b in zip(first, last)], dtype="<u8", count=len(last)
    )
    by_byte = hashes.view(np.uint8)
    set_bits = np.concatenate([np.bincount(by_byte[k::8], minlength=256) @ _BITS for k in range(8)])
    return int(sum(1 << j for j in np.flatnonzero(2 * set_bits > len(last)).tolist()))


def fingerprint_column(text: Column, settings: SimHashSettings) -> Column:
    """The fingerprint as a signed long."""
    words, seed = settings.shingle_words, settings.seed

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        got = np.array([fingerprint(t, words, seed) for t in texts], dtype=np.uint64)
        return pd.Series(got.view(np.int64))

    return fingerprints(text)


def first_addresses(max_bits: int) -> list[tuple[int, ...]]:
    """The byte positions that address each posting list."""
    k = -(-(8 - max_bits) // 2)
    return [p for half in (range(4), range(4, 8)) for p in combinations(half, k)]


def longer_addresses(positions: tuple[int, ...], max_bits: int) -> list[tuple[int, ...]]:
    """All sets of 8 - max_bits positions that hold ``positions``."""
    rest = [p for p in range(8) if p not in positions]
    return [tuple(sorted(positions + more)) for more in combinations(rest, 8 - max_bits - len(positions))]


def _mask(positions: tuple[int, ...]) -> int:
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _posting(positions: tuple[int, ...]) -> Column:
    """A list's address: which positions, and the bytes there."""
    which = sum(1 << p for p in positions)
    return F.struct(F.lit(which).alias("which"), F.col("fp").bitwiseAND(F.lit(_mask(positions))).alias("bytes"))


def postings(nodes: DataFrame, settings: SimHashSettings) -> DataFrame:
    """(which, bytes, fp, node): every fingerprint in each of its lists."""
    short = first_addresses(settings.max_bits)
    lists = nodes.select("fp", "node", F.inline(F.array(*[_posting(p) for p in short])))
    sizes = lists.groupBy("which", "bytes").agg(F.count("*").alias("n"))
    long = written(sizes.where(F.col("n") > settings.list_limit).drop("n"), "long-lists")
    kept = lists.join(long, ["which", "bytes"], "left_anti")
    split = lists.join(long, ["which", "bytes"], "left_semi")
    by_list = [
        split.where(F.col("which") == sum(1 << q for q in p)).select(
            "fp", "node", F.inline(F.array(*[_posting(m) for m in longer_addresses(p, settings.max_bits)]))
        )
        for p in short
    ]
    for more in by_list:
        kept = kept.unionByName(more.select(*kept.columns))
    return kept


def close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs of unsigned fingerprints link: first the tally of shared
    positional bytes, then the bits of the pairs that reach 8 - max_bits."""
    differing = np.bitwise_xor(a, b)
    shared = (differing.view(np.uint8).reshape(*differing.shape, 8) == 0).sum(axis=-1)
    out = shared >= 8 - max_bits
    out[out] = np.bitwise_count(differing[out]) <= max_bits
    return out


def forest(fps: np.ndarray, nodes: np.ndarray, max_bits: int, rows: int = 256):
    """Edges of a spanning forest of the links in one list."""
    left = np.arange(len(fps))
    while len(left):
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            some, frontier = frontier[:rows], frontier[rows:]
            links = close(fps[some][:, None], fps[left][None, :], max_bits)
            met = links.any(axis=0)
            if met.any():
                new = left[met]
                yield nodes[some[links[:, met].argmax(axis=0)]], nodes[new]
                left, frontier = left[~met], np.concatenate([frontier, new])


def link_lists(lists: DataFrame, settings: SimHashSettings) -> DataFrame:
    """(u, v): links between nodes that meet in a list."""
    d, small = settings.max_bits, settings.small

    def links(which: np.ndarray, key: np.ndarray, fps: np.ndarray, nodes: np.ndarray):
        """Whole lists, sorted by (which, key)."""
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (which[1:] != which[:-1])
        starts = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        sizes = np.diff([*starts, len(key)])
        few = sizes[number] <= small
        for gap in range(1, min(small, int(sizes.max(initial=0)))):
            pair = np.flatnonzero((number[gap:] == number[:-gap]) & few[gap:])
            pair = pair[close(fps[pair], fps[pair + gap], d)]
            yield nodes[pair], nodes[pair + gap]
        for s, n in zip(starts[sizes > small], sizes[sizes > small]):
            yield from forest(fps[s : s + n], nodes[s : s + n], d)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []  # rows of the last list, which the next batch may go on with

        def out(pdf):
            got = links(*[pdf[c].to_numpy() for c in ("which", "bytes")],
                        pdf["fp"].to_numpy().view(np.uint64), pdf["node"].to_numpy())
            for u, v in got:
                if len(u):
                    yield pd.DataFrame({"u": u, "v": v})

        for pdf in batches:
            if not len(pdf):
                continue
            held.append(pdf)
            address = pdf[["which", "bytes"]].to_numpy()
            if (address[-1] != held[0][["which", "bytes"]].iloc[0].to_numpy()).any():
                cut = int(np.argmax((address == address[-1]).all(axis=1)))
                yield from out(pd.concat([*held[:-1], pdf.iloc[:cut]], ignore_index=True))
                held = [pdf.iloc[cut:].reset_index(drop=True)]
        if held:
            yield from out(pd.concat(held, ignore_index=True))

    dealt = lists.repartition("which", "bytes").sortWithinPartitions("which", "bytes", "fp")
    return dealt.mapInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, settings: SimHashSettings = SimHashSettings(), *carry: Column) -> DataFrame:
    """doc_id, fp (signed long), component_id (the least doc_id reachable over
    links, itself included), root (the component's least fingerprint) and
    ``carry`` of every document.

    The nodes are the distinct fingerprints, so a doc_id that stands on
    several texts links nothing by itself."""
    text_batches(docs.sparkSession)
    prints = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_column(F.col("text"), settings).alias("fp"), *carry),
        "fingerprints",
    )
    least = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = written(least.select("fp", F.col("fp").alias("node"), "least"), "nodes")
    roots = components(link_lists(postings(nodes.select("fp", "node"), settings), settings))
    rooted = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("root"), "least")
    rooted = written(rooted, "roots")
    groups = rooted.select("fp", "root").join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return prints.join(groups, "fp", "left").withColumns({
        c: F.when(F.col("doc_id").isNotNull(), F.col(c)) for c in ("component_id", "root")
    })


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """One document of each component with all its columns: of the least
    (doc_id, text hash) the first row. Documents without a doc_id belong to no
    component and stay; a doc_id on unrelated texts keeps each of them.

    The documents are written once with a row number, which no two share, and
    joined by it: however many rows repeat a doc_id or a text, none meet in one
    task. Their own columns travel as one struct, so no name can clash."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = written(docs.select(F.monotonically_increasing_id().alias("id"), own), "numbered-documents")
    texts = rows.select("id", F.col("own.doc_id").alias("doc_id"), F.col("own.text").alias("text"))
    found = near_duplicates(texts, settings, F.col("id"), F.xxhash64("text").alias("text_key"))
    first = found.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "text_key", "id")).alias("first"))
    keepers = written(
        first.select("first.id").unionByName(found.where("doc_id is null").select("id")), "kept-documents"
    )
    # neither side has a size bound: a shuffle join at every size
    return rows.join(keepers.hint("merge"), "id").select("own.*")


# DuckDB has no XXH64, so SQL cannot make the fingerprints; tests compare
# with a brute-force version.
