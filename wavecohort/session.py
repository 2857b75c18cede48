"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import threading

from pyspark.sql import DataFrame, SparkSession

# Joins on (id, wave) over a panel hash-partitioned by id reuse that
# partitioning instead of re-shuffling both sides on (id, wave).
RUNTIME_CONF = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_BUILD = threading.RLock()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


class NoSharedFolder(RuntimeError):
    pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``).

    A scratch folder is set only where none is named and driver and executors
    are one process (tests); a cluster without a shared folder is refused,
    since a machine-local one would lose stages.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc._jsc.sc().isLocal():
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="wavecohort-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several results read (memory, spilling to disk).

    Lost blocks are recomputed from lineage, so this survives executor
    loss; identical plans built later reuse the same cached data.
    """
    from pyspark import StorageLevel

    return df.persist(StorageLevel.MEMORY_AND_DISK)


def stage(df: DataFrame) -> DataFrame:
    """A stage boundary shared by many results: a reliable checkpoint in the
    cluster's checkpoint folder (cuts lineage, survives executor loss, and
    keeps later plans short)."""
    return materialize(df)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    # A checkpoint taken under AQE records no output partitioning, so every
    # later per-person step would re-shuffle. Stage plans are exchange-free
    # past the source (they run on co-partitioned data), so build the
    # checkpoint with the static plan, which keeps the hash partitioning.
    # One thread at a time, so that no build restores another's setting.
    with _BUILD:
        previous = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            return df.checkpoint(eager=True)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", previous)


def local_session(cores: int = 8, partitions: int = 8, app: str = "wavecohort") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
