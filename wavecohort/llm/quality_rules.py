"""Quality rules with host verdicts.

Base rules look at one text: too few words, or too large a share of words in
repeated windows. Host rules look at all documents of a host: base failures
are counted per host, the failure rates are shrunk towards the corpus rate by
a beta prior fitted to the hosts (method of moments), and a host whose shrunk
rate passes ``host_limit`` fails with all its documents.

Defined results: a null text has no words and fails; a null host is a host of
its own; repeated rows are judged each, alike; very long texts count whole; a
rate equal to the limit passes; an empty table gives an empty result. Own
columns of ``keep_good`` may have any names and types.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, text_batches, written

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    host_limit: float = 0.5


def repeated_window_words(words: list, window: int) -> int:
    """Words that stand in a window of ``window`` words which occurs twice or
    more in the text. Windows get exact numbers: pairs of numbered pieces are
    numbered anew, doubling their length, and the last step overlaps."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    if len(numbers) == n:
        return 0
    length = 1
    while length < window:
        shift = min(length, window - length)
        pairs = codes[: len(codes) - shift] * (int(codes.max()) + 1) + codes[shift:]
        distinct, codes = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0  # no longer window can repeat
        length += shift
    again = np.flatnonzero(np.bincount(codes)[codes] > 1)
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def text_counts(text: str | None, window: int = 8) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(WORD_SPACE)]
    return (
        len(words),
        len(text) - sum(map(text.count, WORD_SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_window_words(words, window),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_column(text: Column, rules: Rules) -> Column:
    """Struct of COUNTS; the rest of the row stays in the JVM."""
    window = rules.window

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t, window) for t in texts], columns=COUNTS, dtype="int64")

    return counts(text)


def base_failed(counts: Column, rules: Rules) -> Column:
    return (counts["n_words"] < rules.min_words) | (
        100 * counts["n_repeat_words"] > rules.max_repeat_percent * counts["n_words"]
    )


def failed_hosts(docs: DataFrame, host: str, text: str, rules: Rules) -> DataFrame:
    """The hosts that fail: (host_known, host, n_docs, n_failed, rate).

    Partial sums per task, one row per host; the prior's moments are one
    row, computed from the host table and joined to no document.
    """
    counts = count_column(F.col(text), rules)
    judged = docs.select(
        F.coalesce(F.col(host), F.lit("")).alias("host"), F.col(host).isNotNull().alias("host_known"), counts.alias("c")
    )
    hosts = written(
        judged.groupBy("host_known", "host").agg(
            F.count("*").alias("n_docs"), F.sum(base_failed(F.col("c"), rules).cast("long")).alias("n_failed")
        ),
        "hosts",
    )
    strength, mean = prior(hosts)
    rate = (F.col("n_failed") + F.lit(strength * mean)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("rate", rate).where(F.col("rate") > rules.host_limit)


def prior(hosts: DataFrame) -> tuple[float, float]:
    """(strength, mean) of the beta prior: alpha = strength * mean, beta =
    strength * (1 - mean). Method of moments on the hosts' rates; hosts that
    all share one rate give the largest strength, a table without variance
    to explain (0 or 1 everywhere) a strength of 0."""
    rate = F.col("n_failed") / F.col("n_docs")
    row = hosts.agg(
        F.sum("n_failed").alias("failed"), F.sum("n_docs").alias("docs"), F.var_pop(rate).alias("variance")
    ).first()
    if not row["docs"]:
        return 0.0, 0.0
    mean = row["failed"] / row["docs"]
    if mean in (0.0, 1.0):
        return 0.0, mean
    largest = 1e6
    strength = largest if not row["variance"] else mean * (1 - mean) / row["variance"] - 1
    return min(largest, max(0.0, strength)), mean


def judge(docs: DataFrame, rules: Rules = Rules(), host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_rules``: COUNTS, base_failed, host_failed, kept.

    Two scans of the texts: one for the host table, one that judges. The
    failed hosts are joined as a written table, which Spark broadcasts only
    below its threshold.
    """
    text_batches(docs.sparkSession)
    bad = written(
        failed_hosts(docs, host, text, rules).select(
            F.col("host").alias("_host"), F.col("host_known").alias("_known"), F.lit(True).alias("_bad")
        ),
        "failed-hosts",
    )
    counted = docs.withColumn("_c", count_column(F.col(text), rules))
    joined = counted.join(
        bad,
        (F.coalesce(F.col(host), F.lit("")) == F.col("_host")) & (F.col(host).isNotNull() == F.col("_known")),
        "left",
    )
    host_failed = F.coalesce(F.col("_bad"), F.lit(False))
    base = base_failed(F.col("_c"), rules)
    verdict = F.struct(
        *[F.col("_c")[c].alias(c) for c in COUNTS],
        base.alias("base_failed"),
        host_failed.alias("host_failed"),
        (~base & ~host_failed).alias("kept"),
    )
    return joined.withColumn("_rules", verdict).drop("_c", "_host", "_known", "_bad")


def document_verdicts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    judged = judge(docs.select("doc_id", "source", "text"), rules)
    return judged.select(
        F.col("doc_id"), *[F.col("_rules")[c].alias(c) for c in (*COUNTS, "base_failed", "host_failed", "kept")]
    )


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, with their own columns; these travel
    as one struct, so no name can clash."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    judged = judge(docs.select("source", "text", own), rules)
    return judged.where(F.col("_rules")["kept"]).select("own.*")


# DuckDB SQL for ``document_verdicts`` over documents.
SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(source, '') as host, source is not null as known,
    coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select rid, i, array_to_string(w[i : i + 7], ' ') as g
  from (select rid, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8)),
covered as (
  select rid, count(distinct p) as n_repeat_words from (
    select rid, unnest(range(i, i + 8)) as p
    from (select rid, i, count(*) over (partition by rid, g) as n from windows) where n > 1) group by rid),
lines as (
  select rid, count(*) - count(distinct l) as n_dup_lines
  from (select rid, unnest(string_split(text, chr(10))) as l from d)
  where regexp_matches(l, '[^\x20\x09-\x0D]') group by rid),
counts as (
  select d.rid, doc_id, host, known, cast(len(w) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from d left join covered using (rid) left join lines using (rid)),
base as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counts),
hosts as (select known, host, count(*) as n, sum(cast(base_failed as int)) as f from base group by known, host),
moments as (select sum(f) / sum(n) as m, var_pop(f / n) as v from hosts),
prior as (
  select m, case when m in (0, 1) then 0 when v = 0 then 1e6
    else least(1e6, greatest(0, m * (1 - m) / v - 1)) end as s from moments),
bad as (select known, host, (f + s * m) / (n + s) > 0.5 as host_failed from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed,
  not base_failed and not host_failed as kept
from base join bad using (known, host)
"""
