"""Retention, attrition and Kaplan-Meier curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import any_true, id_window
from ..spec import DEFAULT_SPEC, PanelSpec
from .integrity import wave_grid

Z975 = 1.959963984540054


def first_baseline(model_rows: DataFrame, cols: Sequence[str], spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """The Time Zero row of each person among model rows."""
    return (
        model_rows.where(F.col(spec.wave) == F.col("baseline_wave"))
        .withColumn("_rn", F.row_number().over(id_window(spec)))
        .where("_rn = 1")
        .select(spec.id, *cols)
    )


def observed_by_wave(allwaves: DataFrame, persons: DataFrame, spec: PanelSpec = DEFAULT_SPEC, carry: Sequence[str] = ()) -> DataFrame:
    """(id, wave) rows of the cohort's persons (semi-join), with a score flag."""
    rows = allwaves.join(persons.select(spec.id), spec.id, "left_semi")
    aggs = [F.lit(True).alias("row_present")]
    # the first row by value, nulls last: the same whatever the arrival order
    aggs += [F.min(c).alias(c) for c in carry]
    aggs.append(any_true(F.col(spec.score).isNotNull()).alias("observed_cognition"))
    return rows.groupBy(spec.id, spec.wave).agg(*aggs)


def retention_panel(model_rows: DataFrame, allwaves: DataFrame, waves: Column | Sequence[int], spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """V8: grid from Time Zero to every later extract wave, observed flag,
    follow-up wave."""
    base = first_baseline(model_rows, ["baseline_wave", "menopause_group", "menopause_group_label"], spec)
    grid = wave_grid(base.select(spec.id, "baseline_wave"), "baseline_wave", waves, spec)
    obs = observed_by_wave(allwaves, base, spec)
    d = grid.join(base, spec.id, "left").join(obs, [spec.id, spec.wave], "left")
    return d.withColumns(
        {
            "row_present": F.coalesce("row_present", F.lit(False)),
            "observed_cognition": F.coalesce("observed_cognition", F.lit(False)),
            "followup_wave": F.col(spec.wave) - F.col("baseline_wave"),
        }
    )


def attrition_events(rpanel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """V9: the first missed follow-up (> 0) is the event, an intermittent
    miss included; otherwise censored at the last follow-up."""
    fu = F.col("followup_wave")
    d = rpanel.groupBy(spec.id, "menopause_group", "menopause_group_label", "baseline_wave").agg(
        F.min(F.when((fu > 0) & ~F.col("observed_cognition"), fu)).cast("double").alias("first_missing_followup"),
        F.max(fu).alias("max_followup_wave"),
    )
    ev = F.col("first_missing_followup").isNotNull()
    return d.withColumns(
        {
            "attrition_event": ev,
            "time_to_attrition_or_censor": F.when(ev, F.col("first_missing_followup"))
            .otherwise(F.col("max_followup_wave"))
            .cast("double"),
        }
    )


def km_curve(events: DataFrame, time: str = "time_to_attrition_or_censor", event: str = "attrition_event",
             group: str = "menopause_group_label") -> DataFrame:
    """Kaplan-Meier per group at event times plus a time-0 row.

    Counts per (group, time) first; everything after works on that tiny
    table: at-risk = reverse running sum, S = running product of (1-d/n),
    Greenwood variance = running sum of d/(n(n-d)); log-scale 95% band
    with the upper end capped at 1; se and band NULL once S = 0.
    ``n_censor`` counts censorings at the event time itself;
    ``n_censor_since_previous`` counts those after the previous event time
    up to and including this one (the survival summary's interval view).
    """
    t = events.groupBy(group, time).agg(
        F.count_if(F.col(event)).alias("n_event"),
        F.count_if(~F.col(event)).alias("n_censor"),
        F.count(F.lit(1)).alias("_m"),
    )
    rev = Window.partitionBy(group).orderBy(F.col(time).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = Window.partitionBy(group).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumns({"n_risk": F.sum("_m").over(rev), "_cumc": F.sum("n_censor").over(fwd)})
    ev = t.where(F.col("n_event") > 0)
    # censorings since the previous event time (from the start for the first)
    ev = ev.withColumn(
        "n_censor_since_previous",
        F.col("_cumc") - F.coalesce(F.lag("_cumc").over(Window.partitionBy(group).orderBy(time)), F.lit(0)),
    )
    n, d = F.col("n_risk"), F.col("n_event")
    ev = ev.withColumns(
        {
            "retention_probability": F.product(1 - d / n).over(fwd),
            "_g": F.sum(F.try_divide(d, n * (n - d))).over(fwd),
        }
    )
    s, g = F.col("retention_probability"), F.col("_g")
    pos = s > 0
    ev = ev.withColumns(
        {
            "std_error": F.when(pos, s * F.sqrt(g)),
            "conf_low": F.when(pos, F.exp(F.log(s) - Z975 * F.sqrt(g))),
            "conf_high": F.when(pos, F.least(F.lit(1.0), F.exp(F.log(s) + Z975 * F.sqrt(g)))),
        }
    )
    cols = ["followup_wave", "retention_probability", "std_error", "conf_low", "conf_high", "n_risk", "n_event", "n_censor",
            "n_censor_since_previous", group]
    ev = ev.select(F.col(time).cast("double").alias("followup_wave"), *cols[1:])
    start = events.groupBy(group).agg(F.count(F.lit(1)).alias("n_risk")).select(
        F.lit(0.0).alias("followup_wave"),
        F.lit(1.0).alias("retention_probability"),
        F.lit(0.0).alias("std_error"),
        F.lit(1.0).alias("conf_low"),
        F.lit(1.0).alias("conf_high"),
        "n_risk",
        F.lit(0).cast("long").alias("n_event"),
        F.lit(0).cast("long").alias("n_censor"),
        F.lit(0).cast("long").alias("n_censor_since_previous"),
        group,
    )
    return start.unionByName(ev)


def retention_by_wave(rpanel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """The denominator is the persons whose grid reaches that wave."""
    return (
        rpanel.groupBy("menopause_group_label", "followup_wave")
        .agg(
            F.count_distinct(spec.id).alias("n_baseline_group"),
            F.count_if("observed_cognition").alias("n_observed_cognition"),
        )
        .withColumn("simple_retention_proportion", F.col("n_observed_cognition") / F.col("n_baseline_group"))
    )


def attrition_share(events: DataFrame) -> DataFrame:
    """Events and censorings per group with the within-group share."""
    c = events.groupBy("menopause_group_label", "attrition_event").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy("menopause_group_label")))
