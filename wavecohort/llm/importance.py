"""Quality classifier by data selection with importance resampling (DSIR).

Two generative models over hashed word n-grams (uni- and bigrams in
``buckets`` buckets): the target model counts the documents labelled good,
the raw model all documents. A document's log importance weight is the mean
over its n-grams of log p_target - log p_raw, at the length of a typical
document: the plain sum would let length outweigh quality. Resampling without
replacement by these weights is Gumbel top-k: a standard Gumbel draw, fixed by
the doc_id, is added to each log weight and the k largest stay.

How many stay (k) is not a constant: the share of good documents is unknown,
so k is the number of documents whose log weight reaches the level that all
but ``miss`` of held-out good documents reach. A labelled doc_id counts
once, however many rows repeat it (of different texts the one of the smallest
hash), so the labelled rows used are bounded by ``fit_labels`` and
``held_out_labels``; the raw counts, the weights and the selection cover every
row and whole texts.

The k-th largest key is found exactly by radix: keys are order-preserving
longs, and each of four rounds counts one 16-bit digit among the rows that
share the digits found so far, so a round brings at most 65,536 counts
together. Keys that tie at the k-th place are taken by smaller doc_id, then
text hash.

Defined results: a text without words has weight 0; rows with a null doc_id
draw as doc_id -1; repeated rows share their draw and are kept or dropped
together up to the tie rule; without good labels every weight is 0 and every
document stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import smallest_by_hash, text_batches, worker_cache, written


@dataclass(frozen=True)
class ResampleSettings:
    buckets: int = 1 << 16
    fit_labels: int = 8000  # bound of the labelled rows that fit the target model
    held_out_labels: int = 4000  # bound of those that set k
    miss: float = 0.002  # share of held-out good documents that may fall below the level
    smoothing: float = 1.0
    typical_ngrams: int = 256  # the length at which documents are compared
    prior_ngrams: int = 16  # n-grams of ratio 0 added to each, so that short texts don't run to extremes
    seed: int = 7


def _word_number(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word, 7)


class _Numbers(dict):
    """Word -> 64-bit hash, kept for the words that repeat; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        number = self[word] = _word_number(word)
        return number


def ngram_buckets(text: str | None, buckets: int) -> np.ndarray:
    """The bucket of every word and of every pair of neighbouring words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    numbers = worker_cache("dsir_words", _Numbers)
    one = np.fromiter(map(numbers.__getitem__, words), dtype=np.uint64, count=len(words))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (one[1:] + np.uint64(0x632BE59BD9B4E019))
    both = np.concatenate([one, two])
    both ^= both >> np.uint64(29)
    both *= np.uint64(0xBF58476D1CE4E5B9)
    return ((both >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def labelled_good(labels: DataFrame, settings: ResampleSettings) -> DataFrame:
    """(doc_id, part): a bounded set of doc_ids with a good, non-toxic label,
    those with the smallest hashes; part is fit or held_out, at random."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id")
    )
    draw = F.xxhash64("doc_id", F.lit(settings.seed))
    bound = settings.fit_labels + settings.held_out_labels
    picked = smallest_by_hash(good.distinct(), bound, draw, "doc_id")
    share = round(1000 * settings.fit_labels / bound)
    part = F.when(F.pmod(F.xxhash64("doc_id", F.lit(settings.seed + 1)), F.lit(1000)) < share, "fit").otherwise("held_out")
    return picked.select("doc_id", part.alias("part"))


def labelled_texts(docs: DataFrame, good: DataFrame) -> DataFrame:
    """(doc_id, part, text): one row per labelled doc_id that has documents,
    its text of the smallest hash. ``good`` is bounded by the settings (some
    100 kB), so it may be broadcast; a task sends one row per doc_id at most."""

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, tuple] = {}
        for pdf in batches:
            for row in zip(pdf["doc_id"], pdf["part"], pdf["text_key"], pdf["text"]):
                if row[0] not in found or row[2] < found[row[0]][2]:
                    found[row[0]] = row
        yield pd.DataFrame(list(found.values()), columns=["doc_id", "part", "text_key", "text"])

    rows = docs.join(F.broadcast(good), "doc_id").select("doc_id", "part", F.xxhash64("text").alias("text_key"), "text")
    each = rows.mapInPandas(least, "doc_id long, part string, text_key long, text string")
    one = each.groupBy("doc_id", "part").agg(F.min(F.struct("text_key", "text")).alias("v"))
    return one.select("doc_id", "part", "v.text")


def bucket_counts(docs: DataFrame, labelled: DataFrame, settings: ResampleSettings) -> DataFrame:
    """(bucket, raw, target): n-gram counts over all documents and over the
    labelled texts of part fit; each task sends one row per bucket at most."""
    buckets = settings.buckets

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        for pdf in batches:
            for text, fit in zip(pdf["text"], pdf["fit"]):
                if text:
                    (target if fit else raw)[:] += np.bincount(ngram_buckets(text, buckets), minlength=buckets)
        seen = np.flatnonzero(raw + target)
        yield pd.DataFrame({"bucket": seen, "raw": raw[seen], "target": target[seen]})

    fit = labelled.where("part = 'fit'").select("text", F.lit(True).alias("fit"))
    texts = docs.select("text", F.lit(False).alias("fit")).union(fit)
    each = texts.mapInPandas(count, "bucket long, raw long, target long")
    return each.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(docs: DataFrame, labelled: DataFrame, settings: ResampleSettings) -> np.ndarray:
    """log p_target - log p_raw per bucket; at most ``buckets`` rows reach
    the driver."""
    raw, target = np.zeros(settings.buckets), np.zeros(settings.buckets)
    for row in bucket_counts(docs, labelled, settings).collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(settings.buckets)
    # the target model is smoothed towards the raw one
    p_raw = (raw + settings.smoothing) / (raw.sum() + settings.smoothing * settings.buckets)
    p_target = (target + settings.smoothing * settings.buckets * p_raw) / (
        target.sum() + settings.smoothing * settings.buckets
    )
    return np.log(p_target) - np.log(p_raw)


def log_weight(text: str | None, ratios: np.ndarray, settings: ResampleSettings) -> float:
    found = ratios[ngram_buckets(text, len(ratios))]
    return settings.typical_ngrams * float(found.sum()) / (len(found) + settings.prior_ngrams)


def weight_column(text: Column, ratios: np.ndarray, settings: ResampleSettings) -> Column:
    """The log importance weight of each text."""

    @F.pandas_udf("double")
    def weights(texts: pd.Series) -> pd.Series:
        return pd.Series([log_weight(t, ratios, settings) for t in texts], dtype="float64")

    return weights(text)


def gumbel(doc_id: Column, seed: int) -> Column:
    """A standard Gumbel draw fixed by the doc_id and the seed."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.coalesce(doc_id, F.lit(-1)), F.lit(seed)), 11) + F.lit(0.5)) / F.lit(2.0**53)
    return -F.log(-F.log(unit))


def ordered_key(value: Column) -> Column:
    """A long of the same order as the double: the value in units of 2**-40,
    clamped to the range of a long."""
    scaled = F.floor(F.greatest(F.lit(-(2.0**61)), F.least(F.lit(2.0**61), value * F.lit(2.0**40))))
    return scaled.cast("long")


def kth_largest(keys: DataFrame, key: str, k: int) -> int:
    """The k-th largest (from 1) of a long column, exactly."""
    prefix, shift = None, 48
    base = keys.select((F.col(key).cast("decimal(20,0)") + F.lit(1 << 62)).cast("long").alias("x"))
    # the keys lie in [-2**61, 2**61], so x is a positive long
    while True:
        some = base if prefix is None else base.where(F.shiftright("x", shift + 16) == prefix)
        digit = F.shiftright("x", shift).bitwiseAND(F.lit(0xFFFF))
        counts = some.groupBy(digit.alias("digit")).count().orderBy(F.desc("digit")).collect()  # at most 65,536
        for row in counts:
            if k <= row["count"]:
                found = row["digit"]
                break
            k -= row["count"]
        prefix = found if prefix is None else (prefix << 16) | found
        if not shift:
            return prefix - (1 << 62)
        shift -= 16


def quantile_level(labelled: DataFrame, ratios: np.ndarray, settings: ResampleSettings) -> float | None:
    """The log weight that all but ``miss`` of the held-out good documents
    reach: a bounded set of rows, sorted in one small task."""
    weight = weight_column(F.col("text"), ratios, settings).alias("weight")
    held = labelled.where("part = 'held_out'").select(weight).orderBy("weight").collect()  # bounded by held_out_labels
    return held[int(settings.miss * len(held))]["weight"] if held else None


def selection(scored: DataFrame, level: float | None) -> tuple[int | None, DataFrame | None]:
    """(cut, dropped): rows with a gumbel_key of ``cut`` or more are kept, but
    for the (doc_id, text_key) entries in ``dropped``, which tie at the cut and
    come too late. A cut of None keeps nothing. As many rows are kept as weigh
    ``level`` or more, without a level all. ``scored`` is a written table of
    doc_id, weight, text_key and gumbel_key."""
    k = scored.count() if level is None else scored.where(F.col("weight") >= level).count()
    if k == 0:
        return None, None
    cut = kth_largest(scored, "gumbel_key", k)
    above = scored.where(F.col("gumbel_key") > cut).count()
    ties = scored.where(F.col("gumbel_key") == cut).select("doc_id", "text_key")
    if ties.count() == k - above:
        return cut, None
    # repeated rows share their key: count them per (doc_id, text_key) and take
    # whole entries in order, so that no group is numbered row by row
    entries = ties.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.col("doc_id").asc_nulls_first(), "text_key"))
    late = entries.withColumn("upto", upto).where(F.col("upto") - F.col("n") >= k - above)
    return cut, written(late.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")), "late-ties")


def _scores(docs: DataFrame, ratios: np.ndarray, settings: ResampleSettings) -> DataFrame:
    """``docs`` with weight, text_key and gumbel_key."""
    weighed = docs.withColumn("weight", weight_column(F.col("text"), ratios, settings))
    key = ordered_key(F.col("weight") + gumbel(F.col("doc_id").cast("long"), settings.seed))
    return weighed.withColumns({"text_key": F.xxhash64("text"), "gumbel_key": key})


def _fit(docs: DataFrame, labels: DataFrame, settings: ResampleSettings):
    """(scores of every document as a written table, log ratios, level)."""
    text_batches(docs.sparkSession)
    good = written(labelled_good(labels, settings), "good-labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labelled = written(labelled_texts(texts, good), "labelled-texts")
    ratios = log_ratios(texts, labelled, settings)
    scored = written(_scores(texts, ratios, settings).drop("text"), "weights")
    return scored, ratios, quantile_level(labelled, ratios, settings)


_LATE = "_late"


def _verdict(scored: DataFrame, cut: int | None, dropped: DataFrame | None) -> DataFrame:
    """``scored`` with kept."""
    if cut is None:
        return scored.withColumn("kept", F.lit(False))
    if dropped is None:
        return scored.withColumn("kept", F.col("gumbel_key") >= cut)
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t"))
    late = scored.join(dropped.withColumn(_LATE, F.lit(True)), same, "left")
    kept = (F.col("gumbel_key") >= cut) & ~((F.col("gumbel_key") == cut) & F.coalesce(_LATE, F.lit(False)))
    return late.withColumn("kept", kept).drop("_d", "_t", _LATE)


def resample(docs: DataFrame, labels: DataFrame, settings: ResampleSettings = ResampleSettings()) -> DataFrame:
    """doc_id, text_key, weight, gumbel_key and kept of every document."""
    scored, _, level = _fit(docs, labels, settings)
    return _verdict(scored, *selection(scored, level)).select("doc_id", "text_key", "weight", "gumbel_key", "kept")


def keep_selected(docs: DataFrame, labels: DataFrame, settings: ResampleSettings = ResampleSettings()) -> DataFrame:
    """The selected documents with all their columns.

    The texts are weighed once more beside their row and compared with the
    cut, so no text is shuffled at any size."""
    scored, ratios, level = _fit(docs.select("doc_id", "text"), labels, settings)
    cut, dropped = selection(scored, level)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")  # own names may clash with the scores'
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row)
    kept = _verdict(_scores(rows, ratios, settings), cut, dropped).where("kept")
    return kept.select("_row.*")
