"""Types of text columns, from all their rows (IO1).

Every cell has a set of types that it allows; a column allows what all its
cells allow. The sets only shrink, so they merge in any order: one aggregate of
flags per column over the whole text, with partial results per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# In the order in which a column takes the first that all its cells allow.
TYPES = {"logical": "boolean", "integer": "bigint", "double": "double", "date": "date", "text": "string"}
# The texts of logical cells.
TRUE, FALSE = ("T", "TRUE", "true", "True"), ("F", "FALSE", "false", "False")


def allows(cell: Column) -> dict[str, Column]:
    """Which types a cell that isn't missing allows."""
    number = cell.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return {
        "logical": cell.isin(*TRUE, *FALSE),
        "integer": cell.rlike(r"^[+-]?\d+$") & cell.try_cast("bigint").isNotNull(),
        "double": number & cell.try_cast("double").isNotNull(),
        "date": cell.rlike(r"^\d{4}-\d{2}-\d{2}$") & cell.try_cast("date").isNotNull(),
    }


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, type, n_values, n_missing) of text columns; a column without
    values is of type null. One pass over all rows."""
    columns = list(df.columns if columns is None else columns)
    aggs = []
    for i, name in enumerate(columns):
        cell = F.col(f"`{name}`")
        flags = [F.coalesce(F.bool_and(c), F.lit(True)).alias(t) for t, c in allows(cell).items()]
        aggs.append(F.struct(F.lit(name).alias("column"), F.count(cell).alias("n_values"),
                             F.count_if(cell.isNull()).alias("n_missing"), *flags).alias(f"_{i}"))
    rows = df.agg(*aggs).select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))
    kind = F.when(F.col("n_values") == 0, "null")
    for name in TYPES:
        kind = kind.when(F.col(name) if name != "text" else F.lit(True), name)
    return rows.select("column", kind.alias("type"), "n_values", "n_missing")


def typed(cell: Column, kind: str) -> Column:
    if kind == "logical":
        return F.when(cell.isin(*TRUE), True).when(cell.isin(*FALSE), False)
    return cell.cast(TYPES.get(kind, "string"))


def with_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with its text ``columns`` in the types that all their rows
    allow; a column without values stays text."""
    if not columns:
        return df
    found = {r["column"]: r["type"] for r in infer_types(df, columns).collect()}  # one row per column
    return df.withColumns({name: typed(F.col(f"`{name}`"), kind) for name, kind in found.items()})
