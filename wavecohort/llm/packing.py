"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; pieces are packed
into as few sequences as possible. A piece of full length is a sequence of
its own. The others are dealt evenly into groups of about ``group_pieces``
(one group costs at most one part-filled sequence), and every group is
evolved by ``islands`` populations:

* a chromosome is a list of bins (the grouping representation);
* crossover takes a copy of one parent, injects whole well-filled bins of the
  other, drops the parent's bins that hold an injected piece, and puts the
  displaced pieces back by best fit, longest first;
* the fitness is the bin count, then the mean squared fill (Falkenauer);
* after each epoch the best chromosome of an island migrates to the next
  island of its group; the best of all islands is the group's answer.

A group is done as soon as it reaches ceil(tokens / capacity), below which no
packing exists; epochs go on until no group has won a bin for ``patience`` epochs. Then the least filled bins of all groups are opened, and
their pieces form new, fewer groups that evolve the same way, until one group is
left: so what the borders between groups cost is won back. The state between
epochs is one row per (group, island) in a
written table, so a lost executor costs one epoch of its rows.

Defined results: a null text is a document of the end id alone; repeated rows
are packed each; equal lengths are ordered by row; an empty table packs into
nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_ids import encode_documents, ids_crc32
from .common import text_batches, written


@dataclass(frozen=True)
class PackSettings:
    tokenizer: str = ""
    capacity: int = 2048
    end_id: int = 0
    group_pieces: int = 4096
    islands: int = 2
    patience: int = 2  # epochs without a gain after which a search ends
    population: int = 4
    children: int = 8  # crossovers per island and epoch
    opened: float = 0.04  # share of a group's bins, the least filled, that go on to the next groups
    well_filled: float = 0.98  # share of the capacity from which a bin is injected


PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, settings: PackSettings) -> DataFrame:
    """The pieces of every document. Only documents longer than ``capacity``
    are cut: the first piece takes the remainder, all others are full. ``row``
    numbers the pieces; it is fixed once the table is written."""
    text_batches(docs.sparkSession)
    size = settings.capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            all_ids = encode_documents(pdf["text"], settings.tokenizer, settings.end_id)
            for doc_id, ids in zip(pdf["doc_id"].astype("Int64"), all_ids):
                first = len(ids) % size or size
                cuts = [0, *range(first, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, k, a, b - a, ids_crc32(ids[a:b])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"}).assign(row=0)[[c.split()[0] for c in PIECES.split(", ")]]

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(cut, PIECES)
    return written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")


class Bins:
    """Best fit over the free space of bins, 0 to ``capacity``: a bit mask of
    the free spaces that some bin has, and the bins of each free space."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.free: dict[int, list[int]] = {}
        self.mask = 0

    def _offer(self, b: int, space: int):
        if space:
            self.free.setdefault(space, []).append(b)
            self.mask |= 1 << space

    def add_bin(self, items: list[int]):
        self.bins.append(list(items))
        self._offer(len(self.bins) - 1, self.capacity - sum([self.lengths[i] for i in items]))

    def best_fit(self, item: int):
        need = self.lengths[item]
        fits = self.mask >> need
        if not fits:
            self.bins.append([item])
            self._offer(len(self.bins) - 1, self.capacity - need)
            return
        space = need + (fits & -fits).bit_length() - 1
        waiting = self.free[space]
        b = waiting.pop()
        if not waiting:
            self.mask ^= 1 << space
        self.bins[b].append(item)
        self._offer(b, space - need)


def pack(items, lengths: list[int], capacity: int, bins=()) -> list[list[int]]:
    """``bins`` as they are, and ``items`` put into them by best fit."""
    out = Bins(lengths, capacity)
    for b in bins:
        out.add_bin(b)
    for i in items:
        out.best_fit(i)
    return out.bins


def longest_first(items, lengths: list[int]) -> list[int]:
    return sorted(items, key=lambda i: (-lengths[i], i))


def fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Smaller is better."""
    fills = [sum([lengths[i] for i in b]) / capacity for b in bins]
    return len(bins), -sum(f * f for f in fills)


def crossover(mother, father, lengths: list[int], capacity: int, well_filled: float, rng) -> list[list[int]]:
    """The mother with some whole well-filled bins of the father."""
    full = [b for b in father if sum([lengths[i] for i in b]) >= well_filled * capacity]
    if not full:
        full = list(father)
    share = rng.uniform(0.2, 0.6)
    injected = [b for b in full if rng.random() < share]
    taken = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in mother:
        if taken.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in taken]
    # the least filled bins are broken up too, so that displaced pieces mix
    kept.sort(key=lambda b: sum([lengths[i] for i in b]))
    loose = max(1, len(kept) // 20)
    displaced += [i for b in kept[:loose] for i in b]
    return pack(longest_first(displaced, lengths), lengths, capacity, injected + kept[loose:])


def bins_to_numbers(bins: list[list[int]], n: int) -> list[int]:
    numbers = [0] * n
    for b, items in enumerate(bins):
        for i in items:
            numbers[i] = b
    return numbers


def numbers_to_bins(numbers) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(numbers):
        bins.setdefault(int(b), []).append(i)
    return list(bins.values())


def first_population(lengths: list[int], settings: PackSettings, rng) -> list[list[list[int]]]:
    """Best fit with the longest first, and with slightly shuffled orders."""
    order = longest_first(range(len(lengths)), lengths)
    out = [pack(order, lengths, settings.capacity)]
    while len(out) < settings.population and len(out[0]) > lower_bound(lengths, settings.capacity):
        noisy = sorted(order, key=lambda i: -lengths[i] * rng.uniform(0.9, 1.0))
        out.append(pack(noisy, lengths, settings.capacity))
    return out


def lower_bound(lengths: list[int], capacity: int) -> int:
    return -(-sum(lengths) // capacity)


def evolve(lengths: list[int], people: list[list[list[int]]], settings: PackSettings, rng) -> list[list[list[int]]]:
    """One epoch of one island; the best chromosome comes first."""
    scored = lambda bins: (fitness(bins, lengths, settings.capacity), bins)
    least = lower_bound(lengths, settings.capacity)
    # scored once each; sorting by the score alone keeps the order of equal ones
    people = sorted(map(scored, people), key=lambda p: p[0])
    for _ in range(settings.children):
        if len(people[0][1]) <= least:
            break
        mother, father = (people[int(k)][1] for k in rng.choice(len(people), 2, replace=len(people) < 2))
        people.append(scored(crossover(mother, father, lengths, settings.capacity, settings.well_filled, rng)))
        people = sorted(people, key=lambda p: p[0])[: settings.population]
    return [bins for _, bins in people]


STATE = T.StructType([
    T.StructField("group", T.LongType()), T.StructField("island", T.IntegerType()),
    T.StructField("rows", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.IntegerType())),
    T.StructField("people", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("bins", T.LongType()), T.StructField("squares", T.DoubleType()),
])


def run_epoch(state: DataFrame, settings: PackSettings, epoch: int) -> DataFrame:
    """Evolves every island by one epoch; ``immigrant`` may hold the best
    chromosome of its neighbour."""

    def islands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s in pdf.itertuples(index=False):
                rng = np.random.default_rng([int(s.group), int(s.island), epoch])
                lengths = [int(x) for x in s.lengths]
                if s.people is not None and s.bins <= lower_bound(lengths, settings.capacity):
                    yield pd.DataFrame([tuple(getattr(s, f.name) for f in STATE.fields)], columns=STATE.names)
                    continue  # done: no packing is better
                people = [numbers_to_bins(p) for p in s.people] if s.people is not None else []
                people = people or first_population(lengths, settings, rng)
                if s.immigrant is not None:
                    people.append(numbers_to_bins(s.immigrant))
                people = evolve(lengths, people, settings, rng)
                bins, squares = fitness(people[0], lengths, settings.capacity)
                yield pd.DataFrame(
                    [(s.group, s.island, s.rows, s.lengths, [bins_to_numbers(p, len(lengths)) for p in people], bins, squares)],
                    columns=[f.name for f in STATE.fields],
                )

    return state.mapInPandas(islands, STATE)


def migrate(state: DataFrame, islands: int) -> DataFrame:
    """Each island with the best chromosome of the island before it."""
    elite = state.select(
        "group", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"),
        F.col("people")[0].alias("immigrant"),
    )
    return state.join(elite, ["group", "island"], "left")


def settle(state: DataFrame, settings: PackSettings) -> DataFrame:
    """Epochs with migration until no group gains; the written state of the
    last one."""
    waited, epoch, last = 0, 0, None
    least = F.ceil(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x) / F.lit(settings.capacity))
    while True:
        state = written(run_epoch(state, settings, epoch), "islands")
        best = state.groupBy("group").agg(F.min("bins").alias("bins"), F.first(least).alias("least"))
        row = best.agg(F.sum("bins").alias("bins"), F.count_if(F.col("bins") > F.col("least")).alias("open")).first()  # one row
        waited = 0 if last is None or row["bins"] < last else waited + 1
        if not row["open"] or waited >= settings.patience:
            return state
        last, epoch = row["bins"], epoch + 1
        state = migrate(state, settings.islands)


def packed_groups(short: DataFrame, groups: int, settings: PackSettings, level: int) -> DataFrame:
    """(group, bin, row, length, fill) of every piece, packed in ``groups``
    groups; dealt by a hash of the row number: even whatever the texts are."""
    group = F.pmod(F.xxhash64("row", F.lit(level)), F.lit(groups)).alias("group")
    dealt = short.select(group, "row", F.col("length").cast("int").alias("length"))
    cut = F.sort_array(F.collect_list(F.struct("row", "length")))  # about group_pieces rows
    state = (
        dealt.groupBy("group").agg(cut.alias("p"))
        .select(
            "group", F.explode(F.array(*[F.lit(i) for i in range(settings.islands)])).alias("island"),
            F.col("p.row").alias("rows"), F.col("p.length").alias("lengths"),
            F.lit(None).cast("array<array<int>>").alias("people"), F.lit(None).cast("array<int>").alias("immigrant"),
        )
        .repartition("group", "island")
    )
    best = settle(state, settings).groupBy("group").agg(
        F.min_by(F.struct("rows", "lengths", F.col("people")[0].alias("bin")), F.struct("bins", "squares", "island")).alias("b")
    )
    zipped = F.arrays_zip(F.col("b.rows").alias("row"), F.col("b.lengths").alias("length"), F.col("b.bin").alias("bin"))
    return written(best.select("group", F.inline(zipped)), "packed-groups")


def pack_pieces(pieces: DataFrame, settings: PackSettings) -> DataFrame:
    """``pieces`` (row, length, ...) with sequence_id and offset."""
    from pyspark.sql.window import Window

    full = F.col("length") == settings.capacity
    short = pieces.where(~full)
    left, done, level = short.select("row", "length"), None, 0
    groups = max(1, math.ceil(short.count() / settings.group_pieces))
    while True:
        packed = packed_groups(left, groups, settings, level)
        # a sequence is named by level, group and bin; there are as many levels as halvings of the groups
        name = F.lit(level << 54) + F.shiftleft(F.col("group"), 22) + F.col("bin")
        packed = packed.withColumn("sequence_id", name)
        if groups == 1:
            bins = packed.select("row", "sequence_id") if done is None else done.unionByName(packed.select("row", "sequence_id"))
            break
        fills = packed.groupBy("group", "bin").agg(F.sum("length").alias("fill"))
        place = F.percent_rank().over(Window.partitionBy("group").orderBy("fill", "bin"))  # a few thousand bins a group
        open_ = fills.withColumn("place", place).where((F.col("place") <= settings.opened) & (F.col("fill") < settings.capacity))
        open_ = written(open_.select("group", "bin"), "opened-bins")
        closed = packed.join(open_, ["group", "bin"], "left_anti").select("row", "sequence_id")
        done = closed if done is None else done.unionByName(closed)
        left = written(packed.join(open_, ["group", "bin"], "left_semi").select("row", "length"), "opened-pieces")
        # at most half the groups each time, the last one alone
        groups, level = min(max(1, math.ceil(left.count() / settings.group_pieces)), math.ceil(groups / 2)), level + 1
    # the sequence of a piece, next to the row: joined on the unique row number
    placed = short.join(bins, "row")
    before = Window.partitionBy("sequence_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    # bins from 0 up, full pieces from -1 down
    alone = pieces.where(full).withColumn("offset", F.lit(0).cast("long")).withColumn("sequence_id", -F.col("row") - 1)
    return placed.unionByName(alone)


def pack_documents(docs: DataFrame, settings: PackSettings) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    packed = pack_pieces(cut_pieces(docs, settings), settings)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
