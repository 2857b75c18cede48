"""Oracle panel derived from the driver's ``orders`` table.

Integer arithmetic only, so Spark and DuckDB produce identical rows. The
same SQL text (``PANEL_SQL``) is the DuckDB oracle's panel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import DEFAULT_SPEC, PanelSpec
from .panel import partition_by_person

# Fixed derivation rule of the test panel (shared with the SQL oracle).
_PERSON_WAVE = [
    "cast(k as bigint) as hhidpn",
    "w as wave",
    "yr as year",
    "cast(yr - rabyear as double) as agey_e",
    "cast(cog as double) as cogtot27_imp",
    "case when cog >= 12 then 1 when cog >= 7 then 2 when cog >= 0 then 3 end as cogfunction",
    "case when k % 19 = 0 then null when k % 8 = 0 then 0 else 1 end as Female",
    "case when k % 8 = 0 then 1 else 2 end as ragender",
    """case when k % 13 = 0 then '7.Premenopausal' when k % 13 = 1 then '8.Unknown type'
       when k % 13 = 2 then null when k % 13 = 3 then '9.Unknown/Inconsistent'
       when k % 6 = 0 then '6.Surgical' when base < 40 then '1.Premature Natural'
       when base < 45 then '2.Early Natural' when base < 50 then '3.45-49 Natural'
       when base <= 55 then '4.50-55 Natural (ref)' else '5.Late Natural' end as meno_combo""",
    "case when k % 6 = 0 then 'Surgical' else 'Natural' end as meno_type",
    """case when base < 40 then '1' when base < 45 then '2' when base < 50 then '3'
       when base <= 55 then '4' else '5' end as meno_age5""",
    """case when s % 17 = 0 then 'Unknown' when w <= 2 and k % 7 = 0 then 'Premenopausal'
       when s % 97 = 0 then 'Premenopausal' else 'Postmenopausal' end as meno_status_time""",
    """cast(case when k % 10 = 0 or s % 4 = 0 then null
       else base + case when s % 11 = 0 then 1 else 0 end end as double) as C253_age""",
    "case when s % 101 = 0 then 1 else 0 end as C253_major_inconsistency",
    "case when s % 61 = 0 then null else rabyear end as rabyear",
    "case when k % 31 = 0 then null else cast(8 + k % 10 as int) end as raedyrs",
    "case when k % 29 = 0 then null else cast(1 + (k + case when s % 53 = 0 then 1 else 0 end) % 5 as int) end as raeduc",
    "case when k % 10 < 7 then 1 when k % 10 < 9 then 2 else 3 end as raracem",
    "case when k % 23 = 0 then null when k % 12 = 5 then 1 else 0 end as rahispan",
]

PANEL_SQL = """
with b as (
  select cast(o_custkey as bigint) as k, cast(year(o_orderdate) - 1994 as int) as w,
         cast(sum(o_orderkey) as bigint) as s
  from orders group by o_custkey, cast(year(o_orderdate) - 1994 as int), cast(o_custkey as bigint)),
c as (
  select k, w, s, cast(1915 + k % 36 as int) as rabyear, cast(1990 + 2 * w as int) as yr,
         cast(36 + (k * 7) % 24 as int) as base,
         case when s % 9 = 0 then null else
           cast(greatest(0, least(27, 14 + (k % 11) - 5 - cast(floor((w * (1 + k % 3)) / 2.0) as int)
             + (s % 5) - 2 - case when k % 6 = 0 then 1 else 0 end)) as int) end as cog
  from b)
select """ + ",\n  ".join(
    e.replace(" as Female", ' as "Female"').replace(" as C253_age", ' as "C253_age"').replace(
        " as C253_major_inconsistency", ' as "C253_major_inconsistency"')
    for e in _PERSON_WAVE
) + "\nfrom c"


def panel_from_orders(orders: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Person-wave panel from orders: one row per (customer, order year).

    The (customer, year) aggregate combines map-side first, so a customer
    holding a large share of all orders still leaves at most one row per
    wave; only then is the (small) panel partitioned by person.
    """
    b = (
        orders.select(
            F.col("o_custkey").cast("bigint").alias("k"),
            (F.year("o_orderdate") - 1994).cast("int").alias("w"),
            F.col("o_orderkey"),
        )
        .groupBy("k", "w")
        .agg(F.sum("o_orderkey").cast("bigint").alias("s"))
    )
    c = b.selectExpr(
        "k", "w", "s",
        "cast(1915 + k % 36 as int) as rabyear",
        "cast(1990 + 2 * w as int) as yr",
        "cast(36 + (k * 7) % 24 as int) as base",
        """case when s % 9 = 0 then null else
           cast(greatest(0, least(27, 14 + (k % 11) - 5 - cast(floor((w * (1 + k % 3)) / 2.0) as int)
             + (s % 5) - 2 - case when k % 6 = 0 then 1 else 0 end)) as int) end as cog""",
    )
    return partition_by_person(c.selectExpr(*_PERSON_WAVE), spec)


def load_panel(spark: SparkSession, sf_dir: str, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    return panel_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"), spec)
