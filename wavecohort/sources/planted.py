"""The test panel as CSV files with planted faults.

The same rule is the SQL check's: which record has which fault follows from its
person and wave. Files hold the persons of one block each, in order of (person,
wave), so a fault's file and record number are known.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .csv_records import read_records
from .panel import PANEL_SCHEMA, canonical_types, parse_diagnostics

# Fixed derivation rule (shared with the SQL oracle).
PERSONS_PER_FILE = 500
KIND = "(hhidpn * 31 + wave * 7) % 23"
REMARKS = {3: 'said "no", then left', 4: "first line\nsecond, line", 5: "one\n\nthree, \"quoted\"\n"}
# kind -> (col, expected, actual)
FAULTS = {
    0: ("cogtot27_imp", "double", "n/k"),
    1: (None, "20 columns", "18 columns"),
    2: (None, "20 columns", "21 columns"),
    4: ("agey_e", "double", "sixty"),
}


def write_planted(panel: DataFrame) -> str:
    """Writes the panel below the shared folder; the path."""
    spark = panel.sparkSession
    names = PANEL_SCHEMA.names
    kind = F.expr(f"cast({KIND} as int)")
    wrong = {FAULTS[k][0]: (k, FAULTS[k][2]) for k in (0, 4)}
    cells = []
    for name in names:
        cell = F.coalesce(F.col(name).cast("string"), F.lit("NA"))
        if name in wrong:
            cell = F.when(F.col("_kind") == wrong[name][0], wrong[name][1]).otherwise(cell)
        cells.append(cell)
    remark = F.lit("")
    for k, text in REMARKS.items():
        quoted = '"' + text.replace('"', '""') + '"'
        remark = F.when(F.col("_kind") == k, quoted).otherwise(remark)
    whole = F.concat_ws(",", *cells, remark)
    line = (
        F.when(F.col("_kind") == 1, F.concat_ws(",", *cells[:-1]))
        .when(F.col("_kind") == 2, F.concat(whole, F.lit(",surplus")))
        .when(F.col("_kind") == 6, F.concat(whole, F.lit("\n")))
        .otherwise(whole)
    )
    block = F.expr(f"cast(floor(hhidpn / {PERSONS_PER_FILE}) as int)").alias("block")
    rows = panel.withColumn("_kind", kind).select(block, F.lit(1).alias("_place"), "hhidpn", "wave", line.alias("value"))
    heads = panel.select(block).distinct().select(
        "block", F.lit(0).alias("_place"), F.lit(None).cast("long").alias("hhidpn"), F.lit(None).cast("int").alias("wave"),
        F.lit(",".join([*names, "remark"])).alias("value"),
    )
    path = f"{checkpoint_dir(spark)}/planted-{uuid.uuid4().hex}"
    ordered = rows.unionByName(heads).repartition("block").sortWithinPartitions("block", "_place", "hhidpn", "wave")
    ordered.select("block", "value").write.partitionBy("block").text(path)
    return path


def planted_diagnostics(panel: DataFrame) -> DataFrame:
    """(block, row, col, expected, actual): what the diagnostics find."""
    path = write_planted(panel)
    found = parse_diagnostics(panel.sparkSession, path)
    block = F.regexp_extract("path", "block=([0-9]+)/", 1).cast("int").alias("block")
    return found.select(block, "row", "col", "expected", "actual")


def planted_records(panel: DataFrame) -> DataFrame:
    """The panel as it is read back from the files, with the remarks."""
    back = canonical_types(read_records(panel.sparkSession, write_planted(panel)))
    return back.select(*PANEL_SCHEMA.names, "remark")


# Columns of mixed text: name -> expression that Spark and the SQL check share.
MIXED_TEXT = {
    "person": "cast(hhidpn as varchar(20))",
    "signed": "case when hhidpn % 2 = 0 then '-' else '+' end || cast(wave as varchar(20))",
    "half": "case when hhidpn % 3 = 0 then cast(wave as varchar(20)) || '.5' else cast(wave as varchar(20)) end",
    "power": "cast(wave as varchar(20)) || 'e' || cast(hhidpn % 5 as varchar(20))",
    "flag": "case when hhidpn % 5 = 0 then null when hhidpn % 2 = 0 then 'T' else 'FALSE' end",
    "day": "cast(year as varchar(20)) || '-0' || cast(1 + hhidpn % 9 as varchar(20)) || '-15'",
    "no_day": "cast(year as varchar(20)) || '-02-' || cast(22 + hhidpn % 9 as varchar(20))",
    "rare_word": "case when hhidpn % 997 = 5 then 'none' else cast(wave as varchar(20)) end",
    "too_large": "cast(hhidpn as varchar(20)) || '0000000000000000000000'",
    "words": "meno_combo",
    "nothing": "cast(null as varchar(20))",
}


def mixed_text(panel: DataFrame) -> DataFrame:
    """Text columns of every kind, from the panel's rows."""
    return panel.selectExpr(*[f"cast({e} as string) as {name}" for name, e in MIXED_TEXT.items()])
