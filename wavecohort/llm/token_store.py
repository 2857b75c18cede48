"""Token ids in a binary file format with a shared zstandard dictionary.

A store is a folder with two Parquet tables:

``dictionary``  one row: the dictionary's bytes, its hash, the bytes per id.
``blocks``      one row per block of documents in ascending doc_id order:
    part, block             the block's place (part: a range of doc_ids)
    start_in_part           ids of the part before this block
    first_doc_id, last_doc_id
    dictionary_hash         which dictionary the frames need
    doc_ids, n_tokens, offsets   the offset index, one entry per document
    payload                 one zstandard frame per document, concatenated

Every document is its own frame over the dictionary, which is trained on a
bounded sample of serialized short texts; the index gives a document's
frame without touching its neighbours, and Parquet's statistics on
first_doc_id and last_doc_id find its block.

Defined results: a null text is empty (only the end id is written); a null
doc_id sorts first; rows that repeat a doc_id are stored each, in order of their
text's hash; very long texts are one frame in a block of their own; an empty
table gives an empty store that reads back empty. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .bpe_ids import encode_documents
from .common import drop_worker_caches, text_batches, written


@dataclass(frozen=True)
class StoreSettings:
    tokenizer: str
    end_id: int = 0
    sample_documents: int = 2000  # bound of the dictionary's training sample
    sample_chars: int = 20_000  # longer documents don't train it
    dictionary_bytes: int = 65_536
    level: int = 3
    block_documents: int = 512
    block_bytes: int = 1 << 18


BLOCKS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("start_in_part", T.LongType()),
    T.StructField("first_doc_id", T.LongType()), T.StructField("last_doc_id", T.LongType()),
    T.StructField("dictionary_hash", T.StringType()), T.StructField("id_bytes", T.IntegerType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("n_tokens", T.ArrayType(T.LongType())),
    T.StructField("offsets", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()),
])
DICTIONARY = "dictionary_hash string, dictionary binary"
DOCUMENT_IDS = "doc_id long, part int, start_in_part long, n_tokens long, ids binary"


def id_bytes(tokenizer: str) -> int:
    """2 where every id fits into an unsigned 16-bit integer, else 4."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(tokenizer).get_vocab().values()) < 1 << 16 else 4


def make_dictionary(samples: list[bytes], most: int) -> bytes:
    """A dictionary of at most ``most`` bytes and an eighth of the samples,
    by zstandard's trainer; where the trainer finds too little to work with,
    the last bytes of the samples, which zstandard takes as they are. Empty
    only without samples."""
    import zstandard

    whole = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(max(256, min(most, whole // 8)), samples).as_bytes() if whole else b""
    except zstandard.ZstdError:
        return b"".join(samples)[-most:]


def train_dictionary(docs: DataFrame, settings: StoreSettings, width: int) -> tuple[str, bytes]:
    """(hash, bytes) of the dictionary: one task trains it on the ids of the
    ``sample_documents`` different short texts with the smallest hashes; a
    text counts once, however many rows repeat it."""

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = [t for pdf in batches for t in pdf["text"]]
        ids_of = encode_documents(texts, settings.tokenizer, settings.end_id)
        data = make_dictionary([ids.astype(f"<u{width}").tobytes() for ids in ids_of], settings.dictionary_bytes)
        yield pd.DataFrame({"dictionary_hash": [hashlib.sha256(data).hexdigest()], "dictionary": [data]})

    short = docs.where(F.length("text").between(1, settings.sample_chars)).select("text", F.xxhash64("text").alias("draw"))
    # a level that about 4 times the wanted rows lie below; where repeats leave too few texts there, a higher one
    wanted, share = settings.sample_documents, 4 * settings.sample_documents / max(1, docs.count())
    while True:
        level = min((1 << 63) - 1, int(min(1.0, share) * 2**64) - (1 << 63))
        once = short.where(F.col("draw") <= F.lit(level)).groupBy("draw").agg(F.min("text").alias("text"))
        sample = written(once.orderBy("draw").limit(wanted).select("text"), "dictionary-sample")
        if share >= 1 or sample.count() >= wanted:
            break
        share *= 16
    rows = sample.coalesce(1).mapInPandas(train, DICTIONARY).collect()  # one row, bounded
    return (rows[0]["dictionary_hash"], bytes(rows[0]["dictionary"])) if rows else (hashlib.sha256(b"").hexdigest(), b"")


FRAMES = "doc_id long, text_key long, id long, n_tokens long, frame binary"


def encode_frames(docs: DataFrame, settings: StoreSettings, width: int, data: bytes) -> DataFrame:
    """One row per document: its ids as a frame over the dictionary. Encoded
    where the text is read, so that only frames are sorted later; ``id`` numbers
    the rows."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        pressed = zstandard.ZstdCompressor(
            level=settings.level, dict_data=zstandard.ZstdCompressionDict(data) if data else None
        )
        for pdf in batches:
            counts, frames = [], []
            for ids in encode_documents(pdf["text"], settings.tokenizer, settings.end_id):
                counts.append(len(ids))
                frames.append(pressed.compress(ids.astype(f"<u{width}").tobytes()))
            yield pdf[["doc_id", "text_key", "id"]].assign(doc_id=pdf["doc_id"].astype("Int64"), n_tokens=counts, frame=frames)

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("id"), "text")
    return rows.mapInPandas(encode, FRAMES)


def write_store(docs: DataFrame, folder: str, settings: StoreSettings) -> None:
    """Encode ``docs`` (doc_id, text) and write the store.

    The frames are range-partitioned by (doc_id, text hash, row number), so
    rows that repeat are split like any others, and each task lays its range
    into blocks in order."""
    spark = docs.sparkSession
    text_batches(spark, 1000)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    width = id_bytes(settings.tokenizer)
    key, data = train_dictionary(docs, settings, width)
    spark.createDataFrame([(key, data)], DICTIONARY).write.parquet(f"{folder}/dictionary")
    names = [f.name for f in BLOCKS.fields]

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        drop_worker_caches()  # the encoders of the step before
        part = TaskContext.get().partitionId()
        block = start = total = 0
        doc_ids, counts, offsets, frames, size = [], [], [], [], 0

        def row():
            known = [d for d in doc_ids if d is not None]
            return pd.DataFrame(
                [(part, block, start, min(known, default=None), max(known, default=None), key, width,
                  doc_ids, counts, offsets, b"".join(frames))], columns=names,
            )

        for pdf in batches:
            for doc_id, n, frame in zip(pdf["doc_id"].astype("Int64"), pdf["n_tokens"], pdf["frame"]):
                doc_ids.append(None if doc_id is pd.NA else int(doc_id))
                counts.append(n)
                offsets.append(size)
                frames.append(frame)
                size += len(frame)
                total += n
                if size >= settings.block_bytes or len(frames) >= settings.block_documents:
                    yield row()
                    block, start = block + 1, total
                    doc_ids, counts, offsets, frames, size = [], [], [], [], 0
        if frames:
            yield row()

    encoded = written(encode_frames(docs, settings, width, data), "frames")
    order = ("doc_id", "text_key", "id")
    ordered = encoded.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "frame")
    ordered.mapInPandas(lay, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


def part_starts(blocks: DataFrame) -> DataFrame:
    """(part, part_start): ids before each part. One row per part, so the
    running sum over parts handles as many rows as the write had tasks."""
    parts = blocks.groupBy("part").agg(
        F.max(F.col("start_in_part") + F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("part_start"))


def read_store(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids
    (binary, little-endian unsigned 32-bit) of every stored document, or of a
    few doc_ids only: then only blocks whose range holds one are read, and
    only its frames are decompressed."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    [stored] = spark.read.schema(DICTIONARY).parquet(f"{folder}/dictionary").collect()  # one row, bounded
    key, data = stored["dictionary_hash"], bytes(stored["dictionary"])
    starts = written(part_starts(blocks), "part-starts")
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        near = F.lit(False)
        for d in wanted:
            near = near | ((F.col("first_doc_id") <= d) & (F.col("last_doc_id") >= d))
        blocks = blocks.where(near)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        unpressed = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data) if data else None)
        for pdf in batches:
            for b in pdf.itertuples(index=False):
                if b.dictionary_hash != key:
                    raise ValueError(f"block {b.part}/{b.block} needs dictionary {b.dictionary_hash}, the store has {key}")
                rows, start, payload = [], b.start_in_part, memoryview(b.payload)
                ends = [*b.offsets[1:], len(payload)]
                for doc_id, n, at, end in zip(b.doc_ids, b.n_tokens, b.offsets, ends):
                    doc_id = None if pd.isna(doc_id) else int(doc_id)
                    if wanted is None or doc_id in wanted:
                        ids = np.frombuffer(unpressed.decompress(payload[at:end]), dtype=f"<u{b.id_bytes}")
                        rows.append((doc_id, b.part, start, len(ids), ids.astype("<u4").tobytes()))
                    start += n
                out = pd.DataFrame(rows, columns=["doc_id", "part", "start_in_part", "n_tokens", "ids"])
                yield out.astype({"doc_id": "Int64"})

    found = blocks.mapInPandas(decode, DOCUMENT_IDS)
    return found.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )
