"""Records of CSV files that Spark reads in splits, and what is wrong with them.

A quoted cell may hold separators, doubled quotes and line breaks, so whether a
line starts a record depends on every quote before it. Whether a line ends
inside a quoted cell is a function of whether it starts inside one; such
functions (constant, identity, swap) compose, and so do those of whole splits.
So a file needs no reader that passes over it in one task:

1. One aggregate over the lines gives, per split, how many lines it has, how
   many are blank, how many open a cell that they don't close, and how many
   would close one.
2. Only splits with such openers have their lines put in order (narrow rows of
   flags, no text), which gives their function; for the others the counts do.
3. A running composition over the splits of a file (one row each) tells in
   which state every split starts, and a running sum how many records come
   before it.
4. Splits without blank lines, openers and a quoted start hold one record a
   line, whose number follows from its place. In the others lines are numbered
   in order.
5. Every line that is whole by itself is cut and checked where it is read; what
   is kept is its faults. Lines of longer records, and only these, are brought
   together by record, up to ``longest`` characters a record; beyond, the
   record's length is the fault.

Rules: the separator is a comma; a quote opens a cell only at its start, in
other places it is a character; blank lines between records are none; the first
record of a file is its header, on one line; empty cells and ``NA`` are missing.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

CELL = r'(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
WHOLE = f"^{CELL}(?:,{CELL})*+$"  # a line that starts and ends outside a quoted cell
CLOSING = rf'^(?:[^"]++|"")*+"[^,]*+(?:,{CELL})*+$'  # one that starts inside and ends outside
NEXT_CELL = r',("(?:[^"]++|"")*+"[^,]*+|[^,]*+)'

SPLIT = ("_file", "_from")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The files' lines with their place: file, start of the split, and an id
    that ascends within a split."""
    lines = spark.read.text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_from"),
        F.monotonically_increasing_id().alias("_id"), "value",
    )


def _flags(value: Column) -> list[Column]:
    quoted = value.contains('"')
    return [
        (F.trim(value) == "").alias("_blank"),
        (quoted & ~value.rlike(WHOLE)).alias("_opens"),
        (quoted & value.rlike(CLOSING)).alias("_closes"),
    ]


def cells(record: Column) -> Column:
    """The cells of a record's text, unquoted; missing ones are null."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(NEXT_CELL), F.lit(1))

    def plain(c):
        inner = F.regexp_replace(F.regexp_replace(c, r'^"((?:[^"]++|"")*+)"', "$1"), '""', '"')
        return F.when(c.startswith('"'), inner).otherwise(c)

    # without a quote every comma separates
    found = F.when(record.contains('"'), F.transform(raw, plain)).otherwise(F.split(record, ","))
    return F.transform(found, lambda c: F.when(~c.isin("", "NA"), c))


def _composed(const: Column, inside: Column, swap: Column, window) -> tuple[Column, Column]:
    """The composition of all functions up to here: (fixed, swaps). The state
    is (coalesce(fixed, start) + swaps) mod 2."""
    swaps = F.coalesce(F.sum(swap.cast("int")).over(window), F.lit(0))
    fixed = F.last(F.when(const, F.pmod(inside.cast("int") + swaps, F.lit(2))), ignorenulls=True).over(window)
    return fixed, swaps


def _after(fixed: Column, swaps: Column, start: Column) -> Column:
    return F.pmod(F.coalesce(fixed, start) + swaps, F.lit(2))


def split_summary(lines: DataFrame) -> DataFrame:
    """One row per split: its counts, its first line that isn't blank, and the
    state at its end when it starts outside (_t0) and inside (_t1) a cell."""
    flagged = lines.select(*SPLIT, "_id", "value", *_flags(F.col("value")))
    splits = flagged.groupBy(*SPLIT).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"), F.count_if("_blank").alias("_blanks"),
        F.count_if("_opens").alias("_openers"), F.count_if("_closes").alias("_closers"),
        F.min_by(F.when(~F.col("_blank"), F.col("value")), F.when(~F.col("_blank"), F.col("_id"))).alias("_head"),
    )
    splits = materialize(splits)
    opened = flagged.join(splits.where("_openers > 0").select(*SPLIT), list(SPLIT), "left_semi")
    order = Window.partitionBy(*SPLIT).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    opens, closes = F.col("_opens"), F.col("_closes")
    # constant: opens without closing, or closes without opening
    fixed, swaps = _composed(opens != closes, opens, opens & closes, order)
    ends = opened.select(*SPLIT, "_id", fixed.alias("_fixed"), swaps.alias("_swaps"))
    last = ends.groupBy(*SPLIT).agg(F.max_by(F.struct("_fixed", "_swaps"), "_id").alias("_f"))
    last = last.select(*SPLIT, *[_after(F.col("_f._fixed"), F.col("_f._swaps"), F.lit(s)).alias(f"_t{s}") for s in (0, 1)])
    both = splits.join(last, list(SPLIT), "left")
    return both.withColumns({
        "_t0": F.coalesce("_t0", F.lit(0)),
        "_t1": F.coalesce("_t1", F.when(F.col("_closers") > 0, 0).otherwise(1)),
    })


def split_starts(summary: DataFrame) -> DataFrame:
    """``summary`` with the state in which each split starts (_start) and
    whether its lines must be put in order (_mixed)."""
    order = Window.partitionBy("_file").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    t0, t1 = F.col("_t0"), F.col("_t1")
    fixed, swaps = _composed(t0 == t1, t0, (t0 == 1) & (t1 == 0), order)
    start = _after(fixed, swaps, F.lit(0))
    return summary.withColumn("_start", start).withColumn("_mixed", (F.col("_openers") > 0) | (F.col("_blanks") > 0) | (F.col("_start") == 1))


def mixed_lines(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """The lines of mixed splits: whether they start and end inside a cell,
    and how many records of the split start up to them (_nth)."""
    flagged = lines.select(*SPLIT, "_id", F.length("value").alias("_chars"), *_flags(F.col("value")))
    flagged = flagged.join(starts.where("_mixed").select(*SPLIT, "_start"), list(SPLIT))
    order = Window.partitionBy(*SPLIT).orderBy("_id")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    opens, closes = F.col("_opens"), F.col("_closes")
    fixed, swaps = _composed(opens != closes, opens, opens & closes, upto)
    placed = flagged.withColumn("_end", _after(fixed, swaps, F.col("_start")))
    placed = placed.withColumn("_begin", F.coalesce(F.lag("_end").over(order), F.col("_start")))
    head = (F.col("_begin") == 0) & ~F.col("_blank")
    return placed.withColumn("_nth", F.sum(head.cast("long")).over(upto)).select(*SPLIT, "_id", "_chars", "_blank", "_begin", "_end", "_nth")


def with_faults(records: DataFrame, names: list[str], tests: dict[str, tuple[str, object]]) -> DataFrame:
    """(the records' columns but the text ``value``, _fault) for each thing that
    is wrong with a record's cells.

    A record is cut once: its cells are a lambda's variable, which all tests
    read. A plain expression would be repeated for every mention of a cell, and
    a filter on it (also the one that Spark infers below ``explode``) once more."""
    faults = F.get(F.transform(F.array(cells(F.col("value"))), lambda c: _faults(c, names, tests)), F.lit(0))
    rest = [c for c in records.columns if c != "value"]
    return records.select(*rest, F.explode_outer(faults).alias("_fault")).where("_fault is not null")


def _faults(found: Column, names: list[str], tests: dict[str, tuple[str, object]]) -> Column:
    """What is wrong with a record's cells: an array of (col, expected, actual)."""
    width = F.size(found)
    probes = [
        F.when(
            width != len(names),
            F.struct(F.lit(None).cast("string").alias("col"), F.lit(f"{len(names)} columns").alias("expected"),
                     F.concat(width.cast("string"), F.lit(" columns")).alias("actual")),
        )
    ]
    for i, name in enumerate(names):
        if name in tests:
            expected, parse = tests[name]
            cell = F.get(found, F.lit(i))
            wrong = cell.isNotNull() & parse(cell).isNull()
            probes.append(F.when(wrong, F.struct(F.lit(name).alias("col"), F.lit(expected).alias("expected"), cell.alias("actual"))))
    return F.filter(F.array(*probes), lambda s: s.isNotNull())


def _one_fault(expected, actual) -> Column:
    return F.struct(F.lit(None).cast("string").alias("col"), expected.alias("expected"), actual.alias("actual"))


class Records:
    """Where the records of the files under ``path`` lie."""

    def __init__(self, spark: SparkSession, path: str, longest: int = 1 << 20):
        self.spark, self.longest = spark, longest
        self.lines = read_lines(spark, path)
        starts = materialize(split_starts(split_summary(self.lines)))
        self.mixed = materialize(mixed_lines(self.lines, starts))
        in_split = self.mixed.groupBy(*SPLIT).agg(F.max("_nth").alias("_records"))
        counted = starts.join(in_split, list(SPLIT), "left")
        records = F.when(F.col("_mixed"), F.coalesce("_records", F.lit(0))).otherwise(F.col("_n"))
        earlier = Window.partitionBy("_file").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
        self.splits = materialize(counted.withColumn("_before", F.coalesce(F.sum(records).over(earlier), F.lit(0))))
        self.heads = self.splits.where("_from = 0 and _head is not null").select("_file", cells(F.col("_head")).alias("_names"))
        first = self.heads.orderBy("_file").limit(1).collect()  # one row
        self.names: list[str] = [n or "" for n in first[0]["_names"]] if first else []

    def _alone(self, lines: DataFrame) -> DataFrame:
        """Those of ``lines`` (file, split, id and more) that are a record by
        themselves, with its number; the number is 1 for the header."""
        places = self.splits.select(*SPLIT, "_first", "_mixed", "_before")
        placed = lines.join(places, list(SPLIT))
        plain = placed.where(~F.col("_mixed")).withColumn("_record", F.col("_before") + F.col("_id") - F.col("_first") + 1)
        numbered = self.mixed.where("_begin = 0 and _end = 0 and not _blank").select(*SPLIT, "_id", "_nth")
        ordered = placed.where("_mixed").join(numbered, [*SPLIT, "_id"])
        ordered = ordered.withColumn("_record", F.col("_before") + F.col("_nth")).drop("_nth")
        return plain.unionByName(ordered).drop("_first", "_mixed", "_before")

    def whole_lines(self, *more: Column) -> DataFrame:
        """Lines that may be a record by themselves, with ``more`` columns."""
        blank, opens, _ = _flags(F.col("value"))
        return self.lines.where(~blank & ~opens).select(*SPLIT, "_id", *more)

    @cached_property
    def parts(self) -> DataFrame:
        """The lines of records of several lines, with the record's number."""
        inside = self.mixed.where("_begin = 1 or _end = 1").join(self.splits.select(*SPLIT, "_before"), list(SPLIT))
        return inside.withColumn("_record", F.col("_before") + F.col("_nth"))

    @cached_property
    def sizes(self) -> DataFrame:
        """(file, record, characters, whether it is never closed) of those."""
        return materialize(self.parts.groupBy("_file", "_record").agg(
            (F.sum("_chars") + F.count(F.lit(1)) - 1).alias("_size"), F.max_by("_end", F.struct("_from", "_id")).alias("_open")
        ))

    def texts(self) -> DataFrame:
        """(file, record, text) of the closed records of several lines, each
        of at most ``longest`` characters."""
        good = self.sizes.where((F.col("_open") == 0) & (F.col("_size") <= self.longest)).select("_file", "_record")
        members = self.parts.join(good, ["_file", "_record"]).select(*SPLIT, "_id", "_record")
        line = F.struct("_from", "_id", "value")
        ordered = F.transform(F.array_sort(F.collect_list(line)), lambda s: s["value"])
        return self.lines.join(members, [*SPLIT, "_id"]).groupBy("_file", "_record").agg(F.array_join(ordered, "\n").alias("value"))

    def read(self) -> DataFrame:
        """Every record after the headers as text columns by name; records
        that ``record_faults`` lists as unclosed or too long are left out,
        missing cells of short records are null."""
        whole = self._alone(self.whole_lines(F.col("value"))).select("_file", "_record", "value")
        found = whole.unionByName(self.texts()).where("_record > 1").select(cells(F.col("value")).alias("c"))
        return found.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(self.names)])


def read_records(spark: SparkSession, path: str, longest: int = 1 << 20) -> DataFrame:
    """All records of the files under ``path`` as text, whatever line breaks
    their quoted cells hold, read in splits."""
    return Records(spark, path, longest).read()


def record_faults(spark: SparkSession, path: str, tests: dict[str, tuple[str, object]], longest: int = 1 << 20) -> DataFrame:
    """(file, row, col, expected, actual, path) of every fault. ``tests``:
    column -> (name of its type, function of a cell's Column that is null where
    the cell doesn't parse). ``row`` counts the file's records after the header
    from 1, 0 is the header; ``col`` is null where the whole record is at fault."""
    all_records = Records(spark, path, longest)
    names = all_records.names
    if not names:
        return spark.createDataFrame([], "file string, row long, col string, expected string, actual string, path string")
    keep = ["_file", "_record", "_fault"]
    # records of one line are checked where they are read; only faults go on
    alone = all_records._alone(with_faults(all_records.whole_lines(F.col("value")), names, tests)).select(*keep)
    unread = all_records.sizes.where((F.col("_open") == 1) | (F.col("_size") > longest))
    too_long = _one_fault(F.lit(f"{longest} characters"), F.concat(F.col("_size").cast("string"), F.lit(" characters")))
    unclosed = _one_fault(F.lit("a closing quote"), F.lit("end of file"))
    unread = unread.select("_file", "_record", F.when(F.col("_open") == 1, unclosed).otherwise(too_long).alias("_fault"))
    several = with_faults(all_records.texts(), names, tests).select(*keep)
    found = alone.unionByName(unread).unionByName(several).where("_record > 1")  # the first is the header
    heads = all_records.heads.where(~F.col("_names").eqNullSafe(F.array(*[F.lit(n or None) for n in names])))
    shown = F.array_join(F.transform("_names", lambda c: F.coalesce(c, F.lit(""))), ",")
    heads = heads.select("_file", F.lit(1).cast("long").alias("_record"), _one_fault(F.lit(",".join(names)), shown).alias("_fault"))
    out = found.unionByName(heads)
    return out.select(F.regexp_extract("_file", "[^/]*$", 0).alias("file"), (F.col("_record") - 1).alias("row"),
                      "_fault.col", "_fault.expected", "_fault.actual", F.col("_file").alias("path"))
