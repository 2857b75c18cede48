"""Language-model scores of whole texts by a small causal self-attention model,
trained in numpy on the corpus, beside an add-one word model as the base.

Blocks. A task lays its documents into blocks of bounded size. A block numbers
its distinct words; a document is then the numbers of its words (for the base)
and its subword ids (for the attention model), and the block has lists of its
words and of its subword ids with their counts in the training documents.

Base. A word belongs to one of ``BUCKETS`` buckets by its checksum, and a block
has one list of words per bucket. The lists of a bucket meet once: the training
counts of a word are summed and the sum goes back to each of its blocks, so
what is shuffled holds a block's distinct words, not its tokens. A word, however
common, is in no more lists than there are blocks.

Attention model. A word's subwords are the public tokenizer's ids of it with a
space before it; a document is the ids of its words and one end id. There are
``groups`` times ``members`` classes in order of frequency: all but ``shared``
of them are one id of the training documents each, the rarest ids share the
others, runs of about equal count. The model reads classes: one causal
attention layer and one hidden layer over a window of ``window`` places give the
next class, first its group, then the member of that group; an id within a
shared class has its add-one share of the training counts. The output starts at
the classes' add-one shares, so training starts from the unigram model. Over
all ids the probabilities of a next id add up to one.

Training passes over every training document once, in ``rounds`` parts: in a
round every task trains its own copy with Adam on the windows of its
documents, the copies are averaged by their number of ids, and the next round
starts from the average. A copy is some 60,000 numbers, so what is gathered
grows with the tasks and thus with the corpus, and the driver sees one copy.

Scoring. Windows overlap: each is ``window`` places long and starts ``stride``
after the one before, and scores only the places the one before didn't, so
that every id is scored once, with at least ``window - stride`` ids before it
except at the start of a text. Windows of many documents are batched.

Defined results: a null or empty text is its end alone; rows that repeat are
counted and scored each; a null doc_id belongs to the training documents; very
long texts are one document (of many windows) in a block of its own; without
training documents every count is zero, the base is log10(1 / (0 + 0 + 1)) per
token and the model is uniform over the ids of each class; an empty table gives
an empty result. Other columns of the documents are not read. Scores depend on
how Spark deals the training documents to tasks, as any averaged training does;
the base and all counts do not.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_ids import Spelled, piece_cache
from .common import shared_folder, text_batches, worker_cache, written


@dataclass(frozen=True)
class LmSettings:
    tokenizer: str
    modulus: int = 7
    held_out: int = 2  # documents with this remainder don't train
    block_words: int = 200_000  # words of a block that are new to its worker
    block_documents: int = 4096
    block_tokens: int = 1_500_000
    frequent: int = 20_000  # of no effect: common words are counted like all others
    groups: int = 32
    members: int = 48
    shared: int = 100  # classes of many rare ids
    width: int = 16
    hidden: int = 32
    window: int = 24
    stride: int = 20
    rounds: int = 4
    batch: int = 256  # windows a step
    rate: float = 0.02
    decay: float = 0.7  # of the rate from round to round
    seed: int = 11

    @property
    def classes(self) -> int:
        return self.groups * self.members


# ---- blocks of documents --------------------------------------------------------


class WordIds(Spelled):
    """The subword ids of the words (bytes) that a worker has met: the
    tokenizer's merges of the whole word with a space before it. Beyond
    ``keep`` words a block starts with the frequent ones."""

    def __init__(self, path: str, keep: int = 400_000):
        self.pieces = piece_cache(path)
        self.size = self.pieces.tokenizer.get_vocab_size(with_added_tokens=True)
        super().__init__(keep, id_type(self.size + 1))

    def ids_of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flats, starts, at = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)], 0
        for a in range(0, len(pieces), 5000):
            ids, first = self.pieces.spelled([" " + w.decode() for w in pieces[a : a + 5000]])
            flats.append(ids)
            starts.append(at + first)
            at += len(ids)
        starts = np.concatenate(starts)
        return np.concatenate(flats), starts, np.diff(starts, append=at)

    def counted(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often the words of these codes, each so many times, have each id."""
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        index = np.arange(lengths.sum()) + np.repeat(self.starts[codes] - ends + lengths, lengths)
        return np.bincount(self.flat[index], weights=np.repeat(counts, lengths), minlength=self.size + 1)


def word_ids(path: str) -> WordIds:
    return worker_cache("lm-words:" + path, lambda: WordIds(path))


BLOCKS = (
    "block long, doc_id long, held_out boolean, numbers binary, ids binary, words array<binary>, counts array<long>, "
    "bucket int, number int, part int"
)
LAID = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("numbers", pa.binary()), ("ids", pa.binary()),
    ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("bucket", pa.int32()), ("number", pa.int32()), ("part", pa.int32()),
])
WORDS, HELD_OUT, SUBWORDS = -1, -2, -3  # parts that aren't training rounds
BUCKETS = 4096  # of words, by checksum


def lay_blocks(docs: DataFrame, settings: LmSettings) -> DataFrame:
    """A written table of documents (doc_id, held_out, numbers, ids), by the
    training round that reads them; of a row per block and bucket with the
    block's words in it, which are numbered from ``number`` on, and their
    training counts (part ``WORDS``); and of a row per block with the subword
    ids of its training documents as ``numbers`` of four bytes and their counts
    (part ``SUBWORDS``)."""
    spark = docs.sparkSession
    text_batches(spark)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = word_ids(settings.tokenizer)
        block = TaskContext.get().partitionId() << 32
        turn, first, rows, tokens = 0, len(known), [], 0

        def flush():
            known.learn()
            codes, lengths = np.concatenate([r[2] for r in rows]), np.array([len(r[2]) for r in rows])
            # the block's own numbers of its words, in order of their buckets
            number = np.zeros(len(known.words), dtype="<i4")
            number[codes] = 1
            words = np.flatnonzero(number)
            sums = map(zlib.crc32, map(known.words.__getitem__, words.tolist()))
            bucket = np.fromiter(sums, dtype=np.int64, count=len(words)) % BUCKETS
            order = np.argsort(bucket, kind="stable")
            words, bucket = words[order], bucket[order]
            number[words] = np.arange(len(words))
            numbers = number[codes]
            held = np.array([r[1] for r in rows])
            counts = np.bincount(numbers[~np.repeat(held, lengths)], minlength=len(words))
            numbers = packed(numbers, np.append(0, np.cumsum(lengths)).tolist(), len(words))
            doc_ids, held_out, _, parts = zip(*rows)
            yield laid_rows(block, doc_id=doc_ids, held_out=held_out, numbers=numbers, ids=known.spell(codes, lengths), part=parts)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1)).astype(np.int32)
            cuts = np.append(starts, np.int32(len(words)))
            listed = pa.ListArray.from_arrays(cuts, pa.array(list(map(known.words.__getitem__, words.tolist())), type=pa.binary()))
            sums = pa.ListArray.from_arrays(cuts, pa.array(counts, type=pa.int64()))
            yield laid_rows(block, words=listed, counts=sums, bucket=bucket[starts], number=starts, part=[WORDS] * len(starts))
            used = known.counted(words, counts)
            used[known.size] = np.count_nonzero(~held)  # ends
            ids = np.flatnonzero(used)
            yield laid_rows(block, numbers=[ids.astype("<u4").tobytes()], counts=[used[ids].astype(np.int64)], part=[SUBWORDS])
            known.trim()

        for batch in batches:
            for doc_id, held_out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
                words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z, splits at the six bytes
                found = known.codes(words)
                part = HELD_OUT if held_out else turn % settings.rounds
                turn += 1
                rows.append((doc_id, held_out, found, part))
                tokens += len(words)
                # words new to the worker bound those new to the block
                full = len(known) - first >= settings.block_words or len(rows) >= settings.block_documents
                if full or tokens >= settings.block_tokens:
                    yield from flush()
                    block, first, rows, tokens = block + 1, len(known), [], 0
        if rows:
            yield from flush()

    doc_id = F.col("doc_id").cast("long")
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(settings.modulus))
    held_out = F.coalesce(remainder == settings.held_out, F.lit(False))
    rows = docs.select(doc_id.alias("doc_id"), "text", held_out.alias("held_out"))
    path = f"{shared_folder(spark)}/llm-lm-blocks-{uuid.uuid4().hex}"
    rows.mapInArrow(lay, BLOCKS).write.partitionBy("part").option("compression", "zstd").parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


def laid_rows(block: int, **given) -> pa.RecordBatch:
    """Rows of a block; columns that aren't given are null."""
    n = len(given["part"])
    given["block"] = np.full(n, block)
    arrays = [x if isinstance(x := given.get(f.name), pa.Array) else pa.nulls(n, f.type) if x is None else pa.array(x, type=f.type) for f in LAID]
    return pa.RecordBatch.from_arrays(arrays, schema=LAID)


def packed(numbers: np.ndarray, cuts: list[int], words: int) -> list[bytes]:
    """The numbers of a block's texts, which end at ``cuts``, in as many bytes
    each as those of a block of ``words`` words need; this width comes first."""
    width = max(1, (max(words - 1, 0).bit_length() + 7) // 8)
    raw = numbers.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()
    return [bytes([width]) + raw[a * width : b * width] for a, b in zip(cuts, cuts[1:])]


def unpacked(raw: bytes) -> np.ndarray:
    width = raw[0]
    out = np.zeros(((len(raw) - 1) // width, 4), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(-1, width)
    return out.view("<i4").ravel()


def laid_numbers(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a block's texts, end to end, and how many each has."""
    width = raw[0][0] if raw else 1
    return unpacked(bytes([width]) + b"".join([r[1:] for r in raw])), (np.array([len(r) for r in raw], dtype=np.int64) - 1) // width


# ---- the base ---------------------------------------------------------------------


@dataclass(frozen=True)
class Totals:
    tokens: int  # N
    distinct: int  # V
    documents: int  # of the training part; every one has an end


def word_counts(blocks: DataFrame) -> tuple[DataFrame, Totals]:
    """(block, number, c), written: the training counts (eight bytes each) of a
    block's words from ``number`` on, a row for each bucket. And the totals."""
    spark = blocks.sparkSession
    listed = blocks.where(F.col("part") == WORDS).select("bucket", "block", "number", "words", "counts")
    rows = listed.repartition("bucket").sortWithinPartitions("bucket")
    answers = written(rows.mapInArrow(summed, "block long, number int, c binary, n long, v long"), "lm-counts")
    n, v = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    ends = blocks.where(F.col("part") >= 0).count()
    return answers.select("block", "number", "c"), Totals(n + ends, v + (ends > 0), ends)


def summed(batches: Iterator[pa.RecordBatch], limit: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Of lists of words in order of their buckets, the words' counts in all
    lists; whole buckets of at least ``limit`` words at a time. The first row of
    these has their training tokens (n) and distinct words (v)."""
    held, words = [], 0

    def add_up(lists: pa.Table) -> pa.RecordBatch:
        lists = lists.combine_chunks()
        each, counts = (lists.column(c).combine_chunks() for c in ("words", "counts"))
        code = each.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        total = np.bincount(code, weights=counts.flatten().to_numpy()).astype("<i8")  # exact below 2**53
        raw, ends = total[code].tobytes(), np.cumsum(each.value_lengths().to_numpy()).tolist()
        first = np.zeros((2, len(lists)), dtype=np.int64)
        first[:, 0] = total.sum(), np.count_nonzero(total)
        c = pa.array([raw[8 * a : 8 * b] for a, b in zip([0, *ends], ends)], type=pa.binary())
        columns = [lists.column("block").combine_chunks(), lists.column("number").combine_chunks(), c, pa.array(first[0]), pa.array(first[1])]
        return pa.RecordBatch.from_arrays(columns, names=["block", "number", "c", "n", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        words += len(batch.column("words").flatten())
        if words >= limit:
            lists = pa.Table.from_batches(held)
            bucket = lists.column("bucket").to_numpy()
            whole = int(np.searchsorted(bucket, bucket[-1]))  # the last one may go on
            if whole:
                yield add_up(lists.slice(0, whole))
                held = lists.slice(whole).to_batches()
                words = sum(len(x.column("words").flatten()) for x in held)
    if held:
        yield add_up(pa.Table.from_batches(held))


def base_scores(scored: DataFrame, answers: DataFrame, totals: Totals) -> DataFrame:
    """Every document with its token counts and base score: a block's
    documents meet the counts of its words in one bounded group."""

    def meet(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        numbers, lengths = laid_numbers(list(rows["numbers"]))
        found = found.sort_values("number")  # all words of the block, from its first number on
        c = np.frombuffer(b"".join(found["c"]), dtype="<i8")
        share = totals.tokens + totals.distinct + 1
        term, end = np.log10((c + 1) / share), float(np.log10((totals.documents + 1) / share))
        text, n = np.repeat(np.arange(len(rows)), lengths), len(rows)
        out = rows[["doc_id", "held_out", "score"]].copy()
        out["n_tokens"] = lengths + 1
        out["n_known"] = np.bincount(text[c[numbers] > 0], minlength=n) + (totals.documents > 0)
        out["base_score"] = np.bincount(text, weights=term[numbers], minlength=n) + end
        return out

    schema = "doc_id long, held_out boolean, score double, n_tokens long, n_known long, base_score double"
    return scored.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(meet, schema)


# ---- the attention model ------------------------------------------------------------


@dataclass(frozen=True)
class Classes:
    """Which class an id belongs to; ``share`` is the log of its share in it,
    ``weight`` the class's add-one count."""

    of: np.ndarray
    share: np.ndarray
    weight: np.ndarray

    @property
    def end(self) -> int:
        """The class of the end, which is the last id."""
        return int(self.of[-1])


def id_counts(blocks: DataFrame, size: int) -> np.ndarray:
    """Counts of the subword ids in the training documents, the end's among
    them; at most ``size`` rows reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(size, dtype=np.int64)
        for pdf in batches:
            for ids, counts in zip(pdf["numbers"], pdf["counts"]):
                sums[np.frombuffer(ids, dtype="<u4")] += counts
        seen = np.flatnonzero(sums)
        yield pd.DataFrame({"id": seen, "n": sums[seen]})

    each = blocks.where(F.col("part") == SUBWORDS).select("numbers", "counts").mapInPandas(count, "id long, n long")
    out = np.zeros(size, dtype=np.int64)
    for row in each.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        out[row["id"]] = row["n"]
    return out


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def make_classes(counts: np.ndarray, settings: LmSettings) -> Classes:
    """Ids by falling count: one a class, and the rest in ``shared`` runs of
    about equal count; add-one counts, so that every id has a share."""
    n = counts + 1.0
    order = np.argsort(-n, kind="stable")
    own = min(settings.classes - settings.shared, len(n) - 1)
    of = np.zeros(len(n), dtype=np.int64)
    of[order[:own]] = np.arange(own)
    rest = order[own:]
    before = np.cumsum(n[rest]) - n[rest]
    of[rest] = own + (before * settings.shared / n[rest].sum()).astype(np.int64)
    weight = np.bincount(of, weights=n, minlength=settings.classes)
    return Classes(of, np.log(n / weight[of]), weight)


class Parameters:
    """The model's arrays as views of one flat vector. ``up``, ``group`` and
    each group's ``member`` lie with their bias as the last row in one matrix
    (``up_all`` and so on), for inputs that end in a one."""

    def __init__(self, settings: LmSettings, flat: np.ndarray | None = None):
        c, d, h, w, g, m = (
            settings.classes, settings.width, settings.hidden, settings.window, settings.groups, settings.members
        )
        shapes = {
            "embed": (c, d), "place": (w, d), "qkv": (d, 3 * d), "mix": (d, d),
            "up_all": (d + 1, h), "down": (h, d), "group_all": (d + 1, g), "member_all": (g, d + 1, m),
        }
        size = sum(map(math.prod, shapes.values()))
        self.flat = np.zeros(size, dtype=np.float32) if flat is None else np.array(flat, dtype=np.float32)
        at = 0
        for name, shape in shapes.items():
            n = math.prod(shape)
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n
        self.up, self.up_bias = self.up_all[:d], self.up_all[d]
        self.group, self.group_bias = self.group_all[:d], self.group_all[d]
        self.member, self.member_bias = self.member_all[:, :d], self.member_all[:, d]


def start_parameters(classes: Classes, settings: LmSettings) -> Parameters:
    """Random inputs, zero outputs: the first prediction is the classes' share."""
    p, draw = Parameters(settings), np.random.default_rng(settings.seed)
    for name, spread in (("embed", 0.3), ("place", 0.1), ("qkv", settings.width**-0.5), ("mix", 0.1), ("up", settings.width**-0.5)):
        array = getattr(p, name)
        array[:] = draw.normal(0, spread, array.shape)
    weight = classes.weight.reshape(settings.groups, settings.members)
    total = weight.sum(axis=1, keepdims=True)
    # a class without ids (few ids, or one that outweighs a run) has no weight
    with np.errstate(divide="ignore", invalid="ignore"):
        p.group_bias[:] = np.maximum(np.log(total / total.sum())[:, 0], -50)
        p.member_bias[:] = np.where(total > 0, np.maximum(np.log(weight / total), -50), 0)
    return p


def _flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


def _beside(matrix: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """The matrix within zeros of a larger shape."""
    out = np.zeros((rows, columns), dtype=np.float32)
    out[: len(matrix), : matrix.shape[1]] = matrix
    return out


def joined(p: Parameters) -> tuple[np.ndarray, np.ndarray]:
    """(queries times keys with the scores' scale, values times ``mix``): each
    pair acts as one matrix, so that attention reads the places themselves."""
    d = len(p.qkv)
    return (p.qkv[:, :d] @ p.qkv[:, d : 2 * d].T) * np.float32(d**-0.5), p.qkv[:, 2 * d :] @ p.mix


def forward(p: Parameters, inputs: np.ndarray, first: int = 0, pair: tuple | None = None) -> tuple:
    """The last layer's places from ``first`` on of a batch of windows (windows
    x places), and what the gradients need; ``pair`` is what ``joined`` gives.
    Places end in a one, which the residuals carry on, so that biases are part
    of products and the sum of the places that attention reads ends in the sum
    of its weights."""
    (n, w), (classes, d) = inputs.shape, p.embed.shape
    scores, values = pair or joined(p)
    embed, place = np.ones((classes, d + 1), dtype=np.float32), _beside(p.place[:w], w, d + 1)
    embed[:, :d] = p.embed
    x = embed.take(inputs.ravel(), axis=0)
    x.reshape(n, -1)[:] += place.ravel()
    # one matrix product over all places, not one a window
    q = (x[:, :d] @ scores).reshape(n, w, d)[:, first:]
    x = x.reshape(n, w, d + 1)
    s = q @ x[..., :d].transpose(0, 2, 1)
    if s.max(initial=0) > 60:
        np.minimum(s, np.float32(60), out=s)
    np.exp(s, out=s)
    s.reshape(n, -1)[:] *= np.tri(w, dtype=np.float32)[first:].ravel()  # a place sees itself and what is before it
    a = _flat(s @ x)
    over = 1 / a[:, d:]
    a *= over
    y = np.zeros_like(a)
    np.matmul(a[:, :d], values, out=y[:, :d])
    y += _flat(x[:, first:])
    r = y @ p.up_all
    np.maximum(r, np.zeros_like(r), out=r)  # an array of zeros: with a number this takes three times as long
    h = np.zeros_like(y)
    np.matmul(r, p.down, out=h[:, :d])
    h += y
    return x, q, s, a, over, y, r, h


def odds(h: np.ndarray, weights: np.ndarray, bias: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logits, exp(logits), their sum) of every row of ``h``; without a
    ``bias`` it is the last row of the weights."""
    logits = h @ weights
    if bias is not None:
        logits += bias
    return exponentials(logits)


def member_odds(p: Parameters, h: np.ndarray, ends: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for the members of each row's group; the rows lie in order of
    their group, which ends at ``ends``."""
    logits = np.empty((len(h), p.member.shape[2]), dtype=np.float32)
    for g, (a, b) in enumerate(zip([0, *ends], ends)):
        if a < b:
            np.matmul(h[a:b], p.member_all[g], out=logits[a:b])
    return exponentials(logits)


def exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logits, their exponentials, the sum of a row's); where these leave the
    floats' range, the logits are shifted first."""
    ones = np.ones(logits.shape[1], dtype=np.float32)
    with np.errstate(over="ignore"):
        each = np.exp(logits)
        total = each @ ones
    if not (np.isfinite(total).all() and (total > 1e-30).all()):
        logits -= logits.max(axis=1, keepdims=True)
        each = np.exp(logits)
        total = each @ ones
    return logits, each, total


def by_group(targets: np.ndarray, counted: np.ndarray, settings: LmSettings) -> tuple:
    """(places, group, member, ends): the counted places in order of their
    target's group, and where each group ends."""
    places = np.flatnonzero(counted)
    target = targets.ravel()[places]
    group = target // settings.members
    order = np.argsort(group.astype(np.int16), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=settings.groups)).tolist()
    group = group[order]
    return places[order], group, target[order] - group * settings.members, ends


def log_odds(p: Parameters, h: np.ndarray, targets: np.ndarray, counted: np.ndarray, settings: LmSettings) -> tuple:
    """(places, natural log probability of the target class there)."""
    places, group, member, ends = by_group(targets, counted, settings)
    some, rows = _flat(h).take(places, axis=0), np.arange(len(places))
    logits, _, total = odds(some, p.group_all)
    log = logits.take(rows * settings.groups + group).astype(float)
    logits, _, both = member_odds(p, some, ends)
    log += logits.take(rows * settings.members + member)
    log -= np.log(total.astype(float) * both)
    return places, log


def sums_by(where: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows with the same number in ``where``; two columns at a
    time, as the parts of complex numbers."""
    columns = rows.shape[1]
    if columns % 2:
        rows = _beside(rows, len(rows), columns + 1)
    pairs = np.ascontiguousarray(np.ascontiguousarray(rows).view(np.complex64).T)
    out = np.zeros((len(pairs), size), dtype=np.complex64)
    for total, values in zip(out, pairs):
        np.add.at(total, where, values)
    return np.ascontiguousarray(out.T).view(np.float32)[:, :columns]


def gradients(p: Parameters, inputs: np.ndarray, targets: np.ndarray, counted: np.ndarray, settings: LmSettings) -> Parameters:
    """Of the mean negative log probability of ``targets`` where ``counted``."""
    out = Parameters(settings)
    (n, w), d = inputs.shape, p.embed.shape[1]
    scores, values = pair = joined(p)
    x, q, s, a, over, y, r, h = forward(p, inputs, pair=pair)
    places, group, member, ends = by_group(targets, counted, settings)
    some, rows, share = h.take(places, axis=0), np.arange(len(places)), np.float32(1 / len(places))
    _, each, total = odds(some, p.group_all)
    each *= (share / total)[:, None]
    each.reshape(-1)[rows * settings.groups + group] -= share
    out.group_all[:] = (each.T @ some).T  # the product of this shape takes less time
    back, by_members = np.zeros((len(places) + 1, d), dtype=np.float32), np.empty((len(places), d), dtype=np.float32)
    np.matmul(each, p.group.T, out=back[:-1])
    _, each, total = member_odds(p, some, ends)
    each *= (share / total)[:, None]
    each.reshape(-1)[rows * settings.members + member] -= share
    of_members = np.zeros((settings.groups, settings.members, d + 1), dtype=np.float32)
    for g, (i, j) in enumerate(zip([0, *ends], ends)):
        if i < j:
            np.matmul(each[i:j].T, some[i:j], out=of_members[g])
            np.matmul(each[i:j], p.member[g].T, out=by_members[i:j])
    out.member_all[:] = of_members.transpose(0, 2, 1)
    back[:-1] += by_members
    row = np.full(n * w, len(places))  # the last, of zeros, for places that don't count
    row[places] = rows
    dh = back.take(row, axis=0)
    dr = dh @ p.down.T
    dr *= r > 0
    out.down[:], out.up_all[:] = r.T @ dh, (dr.T @ y).T
    dy = dr @ p.up.T
    dy += dh
    # of the weighted sums of places, over the weights' sums; each place's mean
    # is taken off by a further column that meets the ones of x
    da = np.zeros_like(a)
    np.matmul(dy, values.T, out=da[:, :d])
    da *= over
    da[:, d] = (da * a) @ np.full(d + 1, -1, dtype=np.float32)
    da = da.reshape(n, w, d + 1)
    ds = da @ x.transpose(0, 2, 1)
    ds *= s
    dq = _flat(ds @ x[..., :d])
    dx = ds.transpose(0, 2, 1) @ q
    dx += s.transpose(0, 2, 1) @ da[..., :d]
    dx = _flat(dx)
    dx += dq @ scores.T
    dx += dy
    of_scores, of_values = (_flat(x)[:, :d].T @ dq) * np.float32(d**-0.5), a[:, :d].T @ dy
    out.qkv[:, :d], out.qkv[:, d : 2 * d] = of_scores @ p.qkv[:, d : 2 * d], of_scores.T @ p.qkv[:, :d]
    out.qkv[:, 2 * d :], out.mix[:] = of_values @ p.mix.T, p.qkv[:, 2 * d :].T @ of_values
    out.place[:w] = dx.reshape(n, w, d).sum(axis=0)
    out.embed[:] = sums_by(inputs.ravel(), dx, settings.classes)
    return out


def reuse_freed_memory() -> None:
    """Have the C library keep the arrays that a step frees for the next one;
    otherwise a third of the time goes into mapping them anew."""
    import ctypes

    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (OSError, AttributeError):
        return  # another C library: slower, nothing else
    mallopt(-3, 1 << 28)  # M_MMAP_THRESHOLD
    mallopt(-1, 1 << 28)  # M_TRIM_THRESHOLD


class Adam:
    def __init__(self, p: Parameters, rate: float):
        self.p, self.rate, self.step = p, rate, 0
        self.mean, self.square = np.zeros_like(p.flat), np.zeros_like(p.flat)

    def update(self, g: np.ndarray) -> None:
        """One step along ``g``, which is used up."""
        self.step += 1
        # the added 1e-20 keeps what decays out of the slow subnormal numbers
        self.mean *= np.float32(0.9)
        self.mean += np.float32(1e-20)
        self.mean += np.float32(0.1) * g
        g *= g
        g *= np.float32(0.02)
        self.square *= np.float32(0.98)
        self.square += np.float32(1e-20)
        self.square += g
        rate = self.rate * min(1.0, self.step / 20) / (1 - 0.9**self.step)
        np.multiply(self.square, np.float32(1 / (1 - 0.98**self.step)), out=g)
        np.sqrt(g, out=g)
        g += np.float32(1e-8)
        np.divide(self.mean, g, out=g)
        g *= np.float32(rate)
        self.p.flat -= g


def windows(lengths: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end of its text, first place to score) of every window over
    texts laid end to end; a place is scored by the first window that has it."""
    number = 1 + np.maximum(0, -(-(lengths - window) // stride))
    ends = np.cumsum(lengths)
    nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    starts = np.repeat(ends - lengths, number) + nth * stride
    return starts, np.repeat(ends, number), np.where(nth > 0, window - stride, 0)


def laid_classes(laid: np.ndarray, lengths: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """(class of every place, class before it); a text begins after an end."""
    of = classes.of[laid]
    before = np.empty_like(of)
    before[1:] = of[:-1]
    before[np.cumsum(lengths) - lengths] = classes.end
    return of, before


def gather(of: np.ndarray, before: np.ndarray, some: tuple, window: int) -> tuple:
    """(inputs, targets, counted places, index) of some windows."""
    starts, ends, skip = some
    places = np.arange(window)[None, :]
    index = starts[:, None] + places
    counted = (index < ends[:, None]) & (places >= skip[:, None])
    np.minimum(index, ends[:, None] - 1, out=index)
    return before.take(index), of.take(index), counted, index


def _texts(ids: pd.Series, size: int, limit: int = 2_000_000) -> Iterator[tuple]:
    """Yields (rows from, to, ids of these texts laid end to end, lengths),
    each text with its end, the last of ``size`` ids, after it; ``limit`` bytes
    at a time but for one very long text."""
    kind, a, held = id_type(size), 0, 0
    raw = list(ids)
    end = np.array([size - 1], dtype=kind).tobytes()
    for i, text in enumerate(raw):
        held += len(text) + len(end)
        if held >= limit or i == len(raw) - 1:
            laid = np.frombuffer(end.join(raw[a : i + 1]) + end, dtype=kind)
            yield a, i + 1, laid, np.array([len(t) // len(end) + 1 for t in raw[a : i + 1]])
            a, held = i + 1, 0


def train_round(rows: DataFrame, p: Parameters, classes: Classes, rate: float, settings: LmSettings) -> Parameters:
    """The average of the tasks' copies, each trained on its documents and
    weighted by its ids; unchanged where there are none."""
    flat = p.flat

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reuse_freed_memory()
        own = Parameters(settings, flat)
        adam, draw, seen = Adam(own, rate), np.random.default_rng(settings.seed), 0
        for pdf in batches:
            for _, _, laid, lengths in _texts(pdf["ids"], len(classes.of)):
                of, before = laid_classes(laid, lengths, classes)
                all_windows = windows(lengths, settings.window, settings.window)
                order = draw.permutation(len(all_windows[0]))
                for b in range(0, len(order), settings.batch):
                    some = tuple(x[order[b : b + settings.batch]] for x in all_windows)
                    inputs, targets, counted, _ = gather(of, before, some, settings.window)
                    adam.update(gradients(own, inputs, targets, counted, settings).flat)
                seen += len(laid)
        if seen:
            yield pd.DataFrame({"n": [float(seen)], "values": [own.flat.astype(float)]})

    each = rows.select("ids").mapInPandas(train, "n double, values array<double>")
    long = each.select("n", F.posexplode("values").alias("i", "value"))
    means = long.groupBy("i").agg((F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("value")).collect()  # one row per parameter
    out = Parameters(settings, flat)
    for row in means:
        out.flat[row["i"]] = row["value"]
    return out


@dataclass(frozen=True)
class Model:
    classes: Classes
    flat: np.ndarray


def fit(blocks: DataFrame, settings: LmSettings) -> Model:
    size = word_ids(settings.tokenizer).size + 1  # and the end
    classes = make_classes(id_counts(blocks, size), settings)
    p = start_parameters(classes, settings)
    for r in range(settings.rounds):
        p = train_round(blocks.where(F.col("part") == r), p, classes, settings.rate * settings.decay**r, settings)
    return Model(classes, p.flat)


def score_ids(ids: pd.Series, model: Model, settings: LmSettings) -> np.ndarray:
    """log10 probability of every text of ``ids`` (binary)."""
    p, classes = Parameters(settings, model.flat), model.classes
    pair, out = joined(p), np.zeros(len(ids))
    for a, b, laid, lengths in _texts(ids, len(classes.of)):
        of, before = laid_classes(laid, lengths, classes)
        text = np.repeat(np.arange(len(lengths)), lengths)
        total = np.bincount(text, weights=classes.share[laid], minlength=len(lengths))
        all_windows = windows(lengths, settings.window, settings.stride)
        for first in np.unique(all_windows[2]).tolist():  # places that aren't scored are only read
            alike = np.flatnonzero(all_windows[2] == first)
            for at in range(0, len(alike), settings.batch):
                some = tuple(x[alike[at : at + settings.batch]] for x in all_windows)
                inputs, *laid_out = gather(of, before, some, settings.window)
                targets, counted, index = (x[:, first:] for x in laid_out)
                places, log = log_odds(p, forward(p, inputs, first, pair)[-1], targets, counted, settings)
                total += np.bincount(text[index.ravel()[places]], weights=log, minlength=len(lengths))
        out[a:b] = total / np.log(10)
    return out


def score_documents(docs: DataFrame, settings: LmSettings) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score of every document."""
    blocks = lay_blocks(docs, settings)
    model = fit(blocks, settings)
    answers, totals = word_counts(blocks)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reuse_freed_memory()
        for pdf in batches:
            pdf["score"] = score_ids(pdf["ids"], model, settings)
            yield pdf[["block", "doc_id", "held_out", "numbers", "score"]]

    rows = blocks.where(~F.col("part").isin(WORDS, SUBWORDS)).select("block", "doc_id", "held_out", "numbers", "ids")
    scored = rows.mapInPandas(score, "block long, doc_id long, held_out boolean, numbers binary, score double")
    found = base_scores(scored, answers, totals)
    train_tokens = F.lit(totals.tokens).cast("long").alias("train_tokens")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", train_tokens, "base_score", "score")
