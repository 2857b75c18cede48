"""Shared folder, written hand-offs and worker-side caches of the llm operators."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from gc import collect as collect_garbage

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# The six white-space bytes of the word contracts: \x20 and \x09-\x0D. They
# are what bytes.split() splits on.
WORD_SPACE = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, shared by the driver
    and all executors. Where none is named, a one-process session (tests, a
    laptop) gets a scratch folder and a cluster session is refused."""
    return (spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage, survives lost executors, and gives later plans the true
    size of the table, so that Spark broadcasts it only under its own
    threshold (``spark.sql.autoBroadcastJoinThreshold``) and shuffles above it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def smallest_by_hash(rows: DataFrame, n: int, draw, *ties: str) -> DataFrame:
    """The ``n`` rows with the smallest ``draw`` (a 64-bit hash): a bounded
    random sample. Only rows below a level that about 4 n rows reach are
    sorted, so the sort's input stays bounded whatever the table's size."""
    total = rows.count()
    share = min(1.0, 4 * n / max(1, total))
    level = min((1 << 63) - 1, int(share * 2**64) - (1 << 63))
    return rows.where(draw <= F.lit(level)).orderBy(draw, *ties).limit(n)


def worker_cache(name: str, make):
    """One object per Python worker process, kept between tasks.

    Functions of this package are pickled by value, so module globals start
    anew in every task; a module object in ``sys.modules`` does not.
    """
    holder = sys.modules.setdefault("_wavecohort_worker", types.ModuleType("_wavecohort_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def drop_worker_caches() -> None:
    """Gives back the memory of the objects that earlier steps left in this
    Python worker process, where a step needs none of them."""
    import pyarrow

    if sys.modules.pop("_wavecohort_worker", None) is not None:
        collect_garbage()
        pyarrow.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, TypeError, AttributeError):
            pass  # only glibc has it


def text_batches(spark: SparkSession, rows: int = 4000) -> None:
    """Fewer rows per Arrow batch than Spark's default, since rows of texts
    are large; a smaller setting of the session's own stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
