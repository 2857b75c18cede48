"""Panel sources and sinks (IO1-IO10).

A panel is one row per (person, wave). After loading it is hash-partitioned
by person id once; every per-person operator downstream (windows by id,
groupBy id, joins on id or (id, wave)) then runs without another shuffle.
A person holds at most one row per wave (``dedupe="first"`` enforces it
with a map-side-combined aggregate), so the id partitioning cannot be
skewed by a single person.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import DEFAULT_SPEC, PanelSpec
from .column_types import with_types
from .csv_records import read_records, record_faults

PANEL_SCHEMA = T.StructType(
    [
        T.StructField("hhidpn", T.LongType(), False),
        T.StructField("wave", T.IntegerType(), False),
        T.StructField("year", T.IntegerType()),
        T.StructField("agey_e", T.DoubleType()),
        T.StructField("cogtot27_imp", T.DoubleType()),
        T.StructField("cogfunction", T.IntegerType()),
        T.StructField("Female", T.IntegerType()),
        T.StructField("ragender", T.IntegerType()),
        T.StructField("meno_combo", T.StringType()),
        T.StructField("meno_type", T.StringType()),
        T.StructField("meno_age5", T.StringType()),
        T.StructField("meno_status_time", T.StringType()),
        T.StructField("C253_age", T.DoubleType()),
        T.StructField("C253_major_inconsistency", T.IntegerType()),
        T.StructField("rabyear", T.IntegerType()),
        T.StructField("raedyrs", T.IntegerType()),
        T.StructField("raeduc", T.IntegerType()),
        T.StructField("raracem", T.IntegerType()),
        T.StructField("rahispan", T.IntegerType()),
    ]
)


class MissingColumns(ValueError):
    pass


def resolve_columns(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Rename the first present alternative age/score column to its
    canonical name (metadata only, no job)."""
    cols = set(df.columns)
    renames = {}
    for canonical, candidates in ((spec.age, spec.age_candidates), (spec.score, spec.score_candidates)):
        if canonical in cols:
            continue
        for c in candidates:
            if c in cols:
                renames[c] = canonical
                break
    return df.withColumnsRenamed(renames) if renames else df


def require_columns(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, later_phases: bool = True) -> DataFrame:
    need = spec.required() + (list(spec.later_phase_columns) if later_phases else [])
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise MissingColumns("The dataset is missing required column(s): " + ", ".join(missing))
    return df


def partition_by_person(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, partitions: int | None = None) -> DataFrame:
    """Hash-partition by person into an explicit number of partitions
    (default ``spark.sql.shuffle.partitions``). With an explicit count AQE
    does not coalesce the exchange, so a checkpoint of the result keeps its
    hash partitioning and later per-person steps plan no exchange."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, spec.id)


def read_panel(
    spark: SparkSession,
    path: str,
    spec: PanelSpec = DEFAULT_SPEC,
    fmt: str | None = None,
    schema: T.StructType | None = None,
    dedupe: str | None = None,
) -> DataFrame:
    """Load a panel from CSV (R-style ``NA`` nulls) or Parquet, resolve the
    column names, check the contract and partition by person.

    CSV records are found by ``csv_records`` (quoted cells may hold line
    breaks; the files are still read in splits). The panel's columns are cast to
    their types, whatever the data look like; a cell that doesn't parse becomes
    NULL and is listed by ``parse_diagnostics``. Other columns get the narrowest
    type that all their rows allow (``infer_types``). (id, wave) must be unique: by default a panel with
    repeated keys or null ids is refused (a skew-safe aggregate), with
    ``dedupe="first"`` repeated rows are collapsed before the partitioning,
    and ``dedupe="keep"`` keeps them as read."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        reader = spark.read.option("header", True).option("nullValue", "NA")
        df = read_records(spark, path) if schema is None else reader.schema(schema).csv(path)
    else:
        df = spark.read.parquet(path)
    given = set(df.columns)
    df = require_columns(resolve_columns(df, spec), spec)
    renamed = set(df.columns) - given  # canonical names of the panel's age and score
    if fmt == "csv" and schema is None:
        df = with_types(canonical_types(df), [c for c in df.columns if c not in PANEL_SCHEMA.names and c not in renamed])
    if dedupe == "first":
        df = dedupe_first(df, spec)
    elif dedupe is None:
        assert_keys(df, spec)
    return partition_by_person(df, spec)


def canonical_types(df: DataFrame, schema: T.StructType = PANEL_SCHEMA) -> DataFrame:
    """Text columns of the panel cast to their types; integers may be written
    with a decimal point. Other columns stay text."""
    types = {f.name: f.dataType for f in schema.fields}
    typed = [n for n in df.columns if n in types and not isinstance(types[n], T.StringType)]
    return df.withColumns({n: canonical(F.col(n), types[n]) for n in typed})


def canonical(cell: Column, kind: T.DataType) -> Column:
    """A text cell as a panel type, null where it doesn't parse."""
    if isinstance(kind, T.DoubleType):
        return cell.try_cast(kind)
    number = cell.try_cast("double")
    return F.coalesce(cell.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def check_keys(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """One row: null ids and duplicate (id, wave) keys (must both be 0)."""
    per_key = panel.groupBy(spec.id, spec.wave).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col(spec.id).isNull(), F.col("_n"))), F.lit(0)).cast("long").alias("null_ids"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
    )


def assert_keys(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> None:
    row = check_keys(panel, spec).first()
    if row["null_ids"] or row["duplicate_keys"]:
        raise ValueError(
            f"panel key violated: {row['null_ids']} null ids, {row['duplicate_keys']} duplicate (id, wave) keys"
        )


def dedupe_first(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, order: str | None = None) -> DataFrame:
    """Keep one row per (id, wave): the first by ``order`` (default: the
    smallest row by the remaining columns, i.e. deterministic).

    An aggregate (``min_by`` of the whole row), not a window: partial
    aggregation collapses copies map-side, so even a key holding a third
    of all rows never reaches one task whole.
    """
    cols = [c for c in panel.columns if c not in (spec.id, spec.wave)]
    row = F.struct(*[F.col(c) for c in cols])
    key = F.col(order) if order else row
    picked = panel.groupBy(spec.id, spec.wave).agg(F.min_by(row, key).alias("_r"))
    return picked.select(spec.id, spec.wave, *[F.col("_r")[c].alias(c) for c in cols]).select(*panel.columns)


def parse_diagnostics(spark: SparkSession, path: str, schema: T.StructType = PANEL_SCHEMA, longest: int = 1 << 20) -> DataFrame:
    """What does not parse: (file, row, col, expected, actual, path).

    ``csv_records`` finds the records, whatever splits the files are read in:
    quoted cells may hold commas, quotes and line breaks. A cell that its
    column's type doesn't allow is one row with the cell; a record with too few
    or too many columns, one that is longer than ``longest`` characters over
    several lines, or one whose quote is never closed is a row with a null
    ``col``; so is a file whose header differs from the first file's (``row``
    0). ``row`` counts the records of the file after its header from 1. Columns
    that the schema doesn't name are counted and not checked."""
    tests = {
        f.name: (f.dataType.simpleString(), lambda c, kind=f.dataType: canonical(c, kind))
        for f in schema.fields if not isinstance(f.dataType, T.StringType)
    }
    return record_faults(spark, path, tests, longest)


def raw_inventory(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, dataset: str = "panel") -> DataFrame:
    """IO5: one global aggregate over the loaded panel."""
    return panel.agg(
        F.lit(dataset).alias("dataset"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(spec.id).alias("n_persons"),
        F.min(spec.wave).alias("min_wave"),
        F.max(spec.wave).alias("max_wave"),
        F.min(spec.year).alias("min_year"),
        F.max(spec.year).alias("max_year"),
        F.lit(spec.score).alias("cognition_variable"),
        F.lit(spec.age).alias("age_variable"),
        F.lit(spec.exposure_age).alias("menopause_age_variable"),
    )


def validate_counts(id_col: str, over: str = "wave", **named: DataFrame) -> DataFrame:
    """IO10: rows, distinct persons, and least and largest ``over`` of each
    named input (null where an input has no such column), one row each."""
    out = None
    for name, df in named.items():
        has = over in df.columns
        row = df.agg(
            F.lit(name).alias("input"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(id_col).alias("n_persons"),
            (F.min(over) if has else F.lit(None)).cast("int").alias(f"min_{over}"),
            (F.max(over) if has else F.lit(None)).cast("int").alias(f"max_{over}"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """IO6: result table sink (Parquet by default, CSV with header)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("nullValue", "NA").csv(path)
    else:
        w.parquet(path)


def _bucketed_table(spark: SparkSession, columns: str, where: str, key: str, buckets: int) -> DataFrame:
    """The files at ``where`` as a table bucketed by ``key``. The catalog entry
    that tells Spark so is gone when this returns; the frame keeps its plan."""
    name = f"stage_{uuid.uuid4().hex}"
    quoted = where.replace("'", "\\'")
    spark.sql(f"create table {name} ({columns}) using parquet clustered by (`{key}`) sorted by (`{key}`) "
              f"into {buckets} buckets location '{quoted}'")  # fmt: skip
    try:
        return spark.table(name)
    finally:
        spark.sql(f"drop table {name}")  # an external table's rows stay


def _key_sum(df: DataFrame, spec: PanelSpec) -> list[Column]:
    keys = [F.col(c) for c in (spec.id, spec.wave) if c in df.columns]
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*keys).cast("decimal(38,0)")).alias("key_sum")]


def save_stage(df: DataFrame, path: str, spec: PanelSpec = DEFAULT_SPEC, buckets: int | None = None) -> None:
    """IO7: phase hand-off, bucketed by person: a later session that loads it
    plans per-person steps without a shuffle.

    The rows go to a folder of their own; when they are whole, a row of the
    manifest commits them with their layout, count and key checksum. A write
    that dies leaves no manifest row, and readers go on with the version before.
    Older versions stay until the caller removes their folders."""
    spark, path = df.sparkSession, path.rstrip("/")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    rows, name = f"{path}/versions/{version}", f"stage_{uuid.uuid4().hex}"
    writer = df.repartition(n, spec.id).write.format("parquet").bucketBy(n, spec.id).sortBy(spec.id)
    try:
        writer.option("path", rows).saveAsTable(name)
    finally:
        spark.sql(f"drop table if exists {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    written = spark.read.schema(df.schema).parquet(rows).agg(*_key_sum(df, spec))
    commit = written.select(F.lit(version).alias("version"), F.lit(n).alias("buckets"), "n_rows", "key_sum", F.lit(columns).alias("columns"))
    commit.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def load_stage(spark: SparkSession, path: str, spec: PanelSpec = DEFAULT_SPEC, verify: bool = False) -> DataFrame:
    """The rows of the newest whole version that ``save_stage`` wrote, still
    partitioned by person; ``verify`` compares their count and key checksum
    with the manifest first."""
    path = path.rstrip("/")
    newest = require_stage(spark, f"{path}/manifest").orderBy(F.desc("version")).limit(1).first()  # one row
    if newest is None:
        raise MissingStage(f"Required input file is missing: {path}")
    df = _bucketed_table(spark, newest["columns"], f"{path}/versions/{newest['version']}", spec.id, newest["buckets"])
    if verify:
        row = df.agg(*_key_sum(df, spec)).first()  # one row
        if (row["n_rows"], row["key_sum"]) != (newest["n_rows"], newest["key_sum"]):
            raise ValueError(f"{path}: {row['n_rows']} rows do not match the manifest's {newest['n_rows']} or their keys differ")
    return df


class MissingStage(FileNotFoundError):
    pass


def require_stage(spark: SparkSession, path: str) -> DataFrame:
    """IO8: an earlier phase's table, or one clear message where it is absent;
    whatever file system the path names, Spark looks."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingStage(f"Required input file is missing: {path}") from None
        raise
