"""Column helpers with R's null and ordering semantics.

All are built-in Spark expressions (no Python UDF), so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_set(c, values: Iterable) -> Column:
    """``x %in% values``: never NULL (NULL is not a member)."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def any_true(c) -> Column:
    """``any(x, na.rm=TRUE)``: FALSE for an empty or all-NULL group."""
    return F.coalesce(F.bool_or(col(c)), F.lit(False))


def all_true(c) -> Column:
    return F.coalesce(F.bool_and(col(c)), F.lit(True))


def count_true(c) -> Column:
    """``sum(x, na.rm=TRUE)`` of a logical as BIGINT (0 when empty)."""
    return F.count_if(F.coalesce(col(c), F.lit(False)))


def min_where(value, cond) -> Column:
    """``safe_min(if_else(cond, value, NA))``."""
    return F.min(F.when(col(cond), col(value)))


def ordered_join(value, order, sep: str, distinct: bool = False) -> Column:
    """Values of a group concatenated in ``order`` (``paste(collapse=)``).

    NULL values are skipped; ``distinct`` keeps the first occurrence.
    """
    items = F.array_sort(
        F.collect_list(F.when(col(value).isNotNull(), F.struct(col(order).alias("o"), col(value).alias("v"))))
    )
    vals = F.transform(items, lambda x: x["v"])
    if distinct:
        vals = F.array_distinct(vals)
    return F.array_join(vals, sep)


def sorted_unique_join(value, sep: str) -> Column:
    """``paste(sort(unique(na.omit(x))), collapse=sep)``."""
    return F.array_join(F.array_sort(F.collect_set(col(value))), sep)


def as_level(c, levels: Sequence[str]) -> Column:
    """``factor(x, levels=)``: a value outside the levels becomes NULL."""
    return F.when(in_set(c, levels), col(c))


def recode(c, mapping: dict) -> Column:
    """``recode(x, !!!map)``: mapped where a key matches, else unchanged."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, col(c)), col(c))


def clamp(c, lo, hi) -> Column:
    """``pmin(pmax(x, lo), hi)`` keeping NULL."""
    x = col(c)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(F.greatest(x, F.lit(lo) if not isinstance(lo, Column) else lo), F.lit(hi) if not isinstance(hi, Column) else hi))


def flag_female(female, gender) -> Column:
    f, g = col(female), col(gender)
    return F.when(f.isNotNull(), f == 1).when(g.isNotNull(), g == 2)


def as_text(c, dtype: T.DataType) -> Column:
    """``as.character`` of a value: integral doubles print without '.0'."""
    x = col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(
            (x == F.floor(x)) & (F.abs(x) < F.lit(1e15)), x.cast("long").cast("string")
        ).otherwise(x.cast("string"))
    if isinstance(dtype, T.BooleanType):
        return F.when(x, F.lit("TRUE")).when(~x, F.lit("FALSE"))
    return x.cast("string")


def mode_first(df: DataFrame, keys: Sequence[str], value: str, order: str, out: str, count: str | None = None) -> DataFrame:
    """First-tie mode of non-NULL ``value`` per ``keys``; a row counts once, or
    as often as its ``count`` says.

    The most frequent value; among ties the one seen first in ``order``.
    Two partial aggregates, both on the grouping key, so a panel
    partitioned by the key needs no shuffle. Groups without a value
    are absent (left-join them back for NULL).
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg((F.sum(count) if count else F.count(F.lit(1))).alias("_n"), F.min(order).alias("_f"))
    )
    return counted.groupBy(*keys).agg(
        F.max_by(F.col(value), F.struct(F.col("_n"), -F.col("_f"))).alias(out)
    )


def id_window(spec, *order: str):
    return Window.partitionBy(spec.id).orderBy(*[F.col(o).asc_nulls_last() for o in (order or (spec.wave,))])


def fixed(c, digits: int) -> Column:
    """Fixed-point text with ``digits`` decimals (``sprintf('%.nf')``).

    Rounds half up on the decimal value so Spark and SQL engines agree;
    C's printf rounds the binary value and may differ on exact ties.
    """
    d = F.round(col(c).cast(T.DecimalType(38, 10)), digits).cast(T.DecimalType(38, digits))
    return d.cast("string")


def thousands(c) -> Column:
    """Integer with a thousands separator (``format(n, big.mark=',')``)."""
    return F.format_number(col(c).cast("long"), 0)


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row aggregates side by side without a join: stack them
    (each row fills only its own columns) and take the non-NULL value per
    column in one aggregate. (A join on a constant key would be planned as
    a cartesian product.)"""
    cols = [c for f in frames for c in f.columns]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.agg(*[F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in cols])
