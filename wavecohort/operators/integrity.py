"""Panel integrity operators.

Every operator partitions by person id only: on a panel hash-partitioned
by id, the windows, per-person aggregates and id joins below add no
exchange (``explain`` shows the single repartition of the source).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import (
    any_true,
    as_text,
    count_true,
    id_window,
    min_where,
    mode_first,
    ordered_join,
)
from ..spec import DEFAULT_SPEC, PanelSpec


# ---- D1-D4 temporal order ---------------------------------------------------

def first_assessment(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """First row with a score and an age, ordered by age, then wave."""
    w = id_window(spec, spec.age, spec.wave)
    return (
        panel.where(F.col(spec.score).isNotNull() & F.col(spec.age).isNotNull())
        .withColumn("_rn", F.row_number().over(w))
        .where("_rn = 1")
        .select(
            spec.id,
            F.col(spec.wave).alias("first_cog_wave"),
            F.col(spec.year).alias("first_cog_year"),
            F.col(spec.age).alias("first_cog_age"),
            F.col(spec.score).alias("first_cog_score"),
        )
    )


def exposure_age(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Per person first-tie mode, min, max, reports and distinct reports
    of the reported exposure age (all persons, NULL when never reported)."""
    x = spec.exposure_age
    stats = panel.groupBy(spec.id).agg(
        F.min(x).alias("menopause_age_min"),
        F.max(x).alias("menopause_age_max"),
        F.count(x).alias("menopause_age_n_reports"),
        F.size(F.array_distinct(F.collect_list(x))).cast("long").alias("menopause_age_n_distinct"),
    )
    mode = mode_first(panel, [spec.id], x, spec.wave, "menopause_age_resolved")
    return stats.join(mode, spec.id, "left").select(
        spec.id,
        "menopause_age_resolved",
        "menopause_age_min",
        "menopause_age_max",
        "menopause_age_n_reports",
        "menopause_age_n_distinct",
    )


def temporal_order(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """D3: exposure age after the first assessment age is a violation;
    min <= first age < max is ambiguous. Persons without a score are absent."""
    d = first_assessment(panel, spec).join(exposure_age(panel, spec), spec.id, "left")
    res, lo, hi, first = (F.col(c) for c in ("menopause_age_resolved", "menopause_age_min", "menopause_age_max", "first_cog_age"))
    return d.withColumns(
        {
            "temporal_order_violation": res.isNotNull() & first.isNotNull() & (res > first),
            "temporal_order_ambiguous": lo.isNotNull() & hi.isNotNull() & first.isNotNull() & (lo <= first) & (hi > first),
        }
    )


def temporal_order_summary(temporal: DataFrame) -> DataFrame:
    """D4."""
    return temporal.agg(
        F.count(F.lit(1)).alias("persons_with_valid_cognition"),
        F.count("menopause_age_resolved").alias("persons_with_reported_menopause_age"),
        count_true("temporal_order_violation").alias("persons_temporal_order_violation"),
        count_true("temporal_order_ambiguous").alias("persons_temporal_order_ambiguous"),
    )


# ---- D5-D7 time-invariant attributes ---------------------------------------

def invariant_vars(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> list[str]:
    return [v for v in spec.invariant_candidates if v in panel.columns]


def invariant_long(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, variables: Sequence[str] | None = None) -> DataFrame:
    """(id, wave, variable, value-as-text), one row per cell."""
    variables = list(variables or invariant_vars(panel, spec))
    types = dict((f.name, f.dataType) for f in panel.schema.fields)
    # inline(array(struct)) is a Generate, which keeps the panel's id
    # partitioning (``unpivot`` plans an Expand, which drops it)
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), as_text(v, types[v]).alias("value")) for v in variables])
    return panel.select(spec.id, spec.wave, F.inline(cells))


def invariant_diag(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, variables: Sequence[str] | None = None) -> DataFrame:
    """Per (person, variable) reports, distinct reports, the distinct
    values in first-seen order, and whether they disagree."""
    long = invariant_long(panel, spec, variables)
    return (
        long.groupBy(spec.id, "variable")
        .agg(
            F.count("value").alias("n_nonmissing"),
            # distinct count from the value list, not count_distinct (which
            # plans a two-level aggregate and re-shuffles)
            F.size(F.array_distinct(F.collect_list("value"))).cast("long").alias("n_distinct_nonmissing"),
            ordered_join("value", spec.wave, " | ", distinct=True).alias("observed_values"),
        )
        .withColumn("inconsistent", F.col("n_distinct_nonmissing") > 1)
    )


def invariant_summary(diag: DataFrame) -> DataFrame:
    """Per variable."""
    return diag.groupBy("variable").agg(
        F.count(F.lit(1)).alias("persons_checked"),
        F.count_if(F.col("n_nonmissing") == 0).alias("persons_all_missing"),
        F.count_if("inconsistent").alias("persons_inconsistent"),
        (F.count_if("inconsistent") / F.count(F.lit(1))).alias("pct_inconsistent"),
        F.max("n_distinct_nonmissing").alias("max_distinct_values"),
    )


def invariant_cases(diag: DataFrame) -> DataFrame:
    return diag.where("inconsistent")


def invariant_modes(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, variables: Sequence[str] | None = None) -> DataFrame:
    """Per person, the first-tie mode of every time-invariant variable, in
    the variable's own type (one unpivoted aggregate for all variables).

    A person's rows that agree in all variables count as one row with its
    number and first wave before the unpivot, so that what is sorted is a row
    per person, variable and version, not one per cell of the panel."""
    variables = list(variables or invariant_vars(panel, spec))
    types = dict((f.name, f.dataType) for f in panel.schema.fields)
    text = panel.select(spec.id, spec.wave, *[as_text(v, types[v]).alias(v) for v in variables])
    versions = text.groupBy(spec.id, *variables).agg(F.min(spec.wave).alias(spec.wave), F.count(F.lit(1)).alias("_rows"))
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("value")) for v in variables])
    long = versions.select(spec.id, spec.wave, "_rows", F.inline(cells))
    modes = mode_first(long, [spec.id, "variable"], "value", spec.wave, "mode", count="_rows")
    # one value per variable: one aggregate where ``pivot`` plans two
    wide = modes.groupBy(spec.id).agg(*[F.max(F.when(F.col("variable") == v, F.col("mode"))).alias(v) for v in variables])
    persons = panel.select(spec.id).distinct()
    out = persons.join(wide, spec.id, "left")
    return out.select(spec.id, *[_from_text(F.col(v), types[v]).alias(v) for v in variables])


def _from_text(c, dtype: T.DataType):
    if isinstance(dtype, T.BooleanType):
        return F.when(c == "TRUE", True).when(c == "FALSE", False)
    return c.cast(dtype)


def resolve_invariants(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, variables: Sequence[str] | None = None) -> DataFrame:
    """Every row, also one that was NULL, takes the person's mode."""
    variables = list(variables or invariant_vars(panel, spec))
    modes = invariant_modes(panel, spec, variables).select(
        spec.id, *[F.col(v).alias(f"{v}__resolved") for v in variables]
    )
    joined = panel.join(modes, spec.id, "left")
    return joined.select(
        *[F.col(f"{c}__resolved").alias(c) if c in variables else F.col(c) for c in panel.columns]
    )


# ---- D8-D9 status transitions ----------------------------------------------

def standardize_status(c) -> F.Column:
    """'pre' is tested before 'post'; anything else is unknown."""
    s = F.lower(F.col(c))
    return F.when(s.contains("pre"), F.lit("premenopausal")).when(s.contains("post"), F.lit("postmenopausal"))


def transitions(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """A backward transition is status 'pre' after any earlier 'post'."""
    w = id_window(spec)
    std = standardize_status(spec.status)
    rank = F.when(std == "premenopausal", F.lit(0)).when(std == "postmenopausal", F.lit(1))
    d = panel.select(spec.id, spec.wave, spec.status).withColumns(
        {"meno_status_standard": std, "meno_status_rank": rank}
    )
    d = d.withColumn("post_observed", F.coalesce((F.col("meno_status_rank") == 1).cast("int"), F.lit(0)))
    d = d.withColumn(
        "prior_post_observed",
        F.coalesce(F.max("post_observed").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    return d.withColumn(
        "backward_meno_transition", (F.col("meno_status_rank") == 0) & (F.col("prior_post_observed") == 1)
    )


def transition_person(trans: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Any backward step, the first backward wave and the status path."""
    label = F.concat(
        F.col(spec.wave).cast("string"), F.lit(":"), F.coalesce(F.col("meno_status_standard"), F.lit("missing_or_unknown"))
    )
    return trans.withColumn("_label", label).groupBy(spec.id).agg(
        any_true("backward_meno_transition").alias("any_backward_meno_transition"),
        min_where(spec.wave, "backward_meno_transition").alias("first_backward_wave"),
        ordered_join("_label", spec.wave, " -> ").alias("status_sequence"),
    )


def transition_summary(tperson: DataFrame) -> DataFrame:
    return tperson.agg(
        F.count(F.lit(1)).alias("persons_checked"),
        count_true("any_backward_meno_transition").alias("persons_backward_meno_transition"),
    )


def absorbing_state(panel: DataFrame, flag: str, out: str, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Once the flag is true it stays true in every later wave
    (running max over the person's waves; NULL before any report)."""
    w = id_window(spec).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return panel.withColumn(out, F.max(F.col(flag).cast("int")).over(w) == 1)


# ---- D10-D13 missingness ------------------------------------------------------

def all_waves(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> Column:
    """The sorted distinct waves of the extract, as an array: a scalar
    subquery over a one-row aggregate, evaluated with the query that uses it.
    Nothing is pulled to the driver and no number of waves is refused.
    """
    return panel.agg(F.array_sort(F.collect_set(spec.wave)).alias("waves")).scalar()


def wave_grid(persons: DataFrame, start: str, waves: Column | Sequence[int], spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """(id, wave) for every extract wave at or after the person's start.

    ``persons`` keeps its id partitioning: the grid is an explode, not a join.
    """
    # a subquery may not stand inside a lambda's function, so it gets a column
    waves = waves if isinstance(waves, Column) else F.lit([int(w) for w in waves])
    return persons.withColumn("_waves", waves).select(
        F.col(spec.id), F.explode(F.filter("_waves", lambda x: x >= F.col(start))).alias(spec.wave)
    )


def missing_panel(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, waves: Column | Sequence[int] | None = None) -> DataFrame:
    """Grid from each person's first wave to every later extract wave,
    with state valid / row but no score / no row."""
    waves = waves if waves is not None else all_waves(panel, spec)
    span = panel.groupBy(spec.id).agg(F.min(spec.wave).alias("first_observed_wave"))
    grid = wave_grid(span, "first_observed_wave", waves, spec)
    # one row per (id, wave); where a key repeats, the least non-null value, so
    # that the result doesn't depend on the order of arrival
    by_wave = panel.groupBy(spec.id, spec.wave).agg(
        F.lit(True).alias("row_present"),
        F.min(spec.year).alias("year"),
        F.min(spec.age).alias("age"),
        F.min(spec.score).alias("cognition"),
    )
    d = grid.join(by_wave, [spec.id, spec.wave], "left").withColumn(
        "row_present", F.coalesce("row_present", F.lit(False))
    )
    valid = F.col("row_present") & F.col("cognition").isNotNull()
    return d.withColumn("valid_cognition", valid).withColumn(
        "missing_state",
        F.when(F.col("valid_cognition"), "valid_cognition")
        .when(F.col("row_present") & F.col("cognition").isNull(), "observed_row_missing_cognition")
        .when(~F.col("row_present"), "no_person_wave_row")
        .otherwise("unclassified"),
    )


def missingness_by_wave(mpanel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """D11."""
    return (
        mpanel.groupBy(spec.wave)
        .agg(
            F.count(F.lit(1)).alias("persons_in_risk_set"),
            F.count_if("row_present").alias("person_wave_rows_present"),
            F.count_if("valid_cognition").alias("valid_cognition"),
            F.count_if(F.col("missing_state") == "observed_row_missing_cognition").alias("observed_rows_missing_cognition"),
            F.count_if(F.col("missing_state") == "no_person_wave_row").alias("no_person_wave_row"),
        )
        .withColumn("total_missing_cognition_or_row", F.col("observed_rows_missing_cognition") + F.col("no_person_wave_row"))
        .withColumn("pct_missing_cognition_or_row", F.col("total_missing_cognition_or_row") / F.col("persons_in_risk_set"))
    )


def missingness_person(mpanel: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """O/M/N pattern, flags relative to the first and last valid wave,
    and the class tested in order (A9: compare rows with the group's own
    aggregates through a whole-person window, then aggregate)."""
    whole = Window.partitionBy(spec.id)
    valid = F.col("valid_cognition")
    wv = F.col(spec.wave)
    d = mpanel.withColumns(
        {
            "_first": F.min(F.when(valid, wv)).over(whole),
            "_last": F.max(F.when(valid, wv)).over(whole),
            "_ch": F.when(valid, "O")
            .when(F.col("missing_state") == "observed_row_missing_cognition", "M")
            .when(F.col("missing_state") == "no_person_wave_row", "N")
            .otherwise("?"),
        }
    )
    p = d.groupBy(spec.id).agg(
        F.count(F.lit(1)).alias("n_panel_waves"),
        F.count_if(valid).alias("n_valid_cognition"),
        F.count_if(F.col("missing_state") == "observed_row_missing_cognition").alias("n_observed_rows_missing_cognition"),
        F.count_if(F.col("missing_state") == "no_person_wave_row").alias("n_no_person_wave_row"),
        F.min("_first").alias("first_valid_cog_wave"),
        F.max("_last").alias("last_valid_cog_wave"),
        any_true(~valid & (wv > F.col("_first")) & (wv < F.col("_last"))).alias("any_missing_between_valid_cognition"),
        any_true(~valid & (wv > F.col("_last"))).alias("any_missing_after_last_valid_cognition"),
        any_true(~valid & (wv < F.col("_first"))).alias("any_missing_before_first_valid_cognition"),
        ordered_join("_ch", spec.wave, "").alias("missingness_pattern"),
    )
    cls = (
        F.when(F.col("n_valid_cognition") == 0, "zero_valid_cognitive_assessments")
        .when((F.col("n_observed_rows_missing_cognition") == 0) & (F.col("n_no_person_wave_row") == 0), "complete_from_entry_to_last_wave")
        .when(F.col("any_missing_between_valid_cognition"), "intermittent_missingness")
        .when(F.col("any_missing_after_last_valid_cognition"), "monotone_missingness_attrition_compatible")
        .when(F.col("any_missing_before_first_valid_cognition"), "missing_before_first_valid_cognition_only")
        .otherwise("other_missingness_pattern")
    )
    return p.withColumn("missingness_class", cls)


def count_share(df: DataFrame, by: str | Sequence[str], name: str = "n_persons", share: str = "pct_persons") -> DataFrame:
    """A1: counts and their share of the total (the total is a one-row-per-
    key window over an already aggregated, tiny frame)."""
    by = [by] if isinstance(by, str) else list(by)
    c = df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    return c.withColumn(share, F.col(name) / F.sum(name).over(Window.partitionBy()))


def missingness_summary(mperson: DataFrame) -> DataFrame:
    """D13."""
    return count_share(mperson, "missingness_class")


# ---- D14-D17 integrity exclusion -----------------------------------------

def integrity_flags(
    resolved: DataFrame,
    temporal: DataFrame,
    tperson: DataFrame,
    spec: PanelSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Per person flags and the exclusion reason."""
    if spec.exposure_inconsistency in resolved.columns:
        c253 = resolved.groupBy(spec.id).agg(
            any_true(F.col(spec.exposure_inconsistency) == 1).alias("any_c253_major_inconsistency")
        )
    else:
        c253 = resolved.select(spec.id).distinct().withColumn("any_c253_major_inconsistency", F.lit(False))
    persons = resolved.select(spec.id).distinct()
    d = (
        persons.join(
            temporal.select(spec.id, "temporal_order_violation", "temporal_order_ambiguous", "first_cog_age", "menopause_age_resolved"),
            spec.id,
            "left",
        )
        .join(tperson.select(spec.id, "any_backward_meno_transition", "first_backward_wave"), spec.id, "left")
        .join(c253, spec.id, "left")
    )
    flags = ["temporal_order_violation", "temporal_order_ambiguous", "any_backward_meno_transition", "any_c253_major_inconsistency"]
    d = d.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})
    tv, bw = F.col("temporal_order_violation"), F.col("any_backward_meno_transition")
    return d.withColumns(
        {
            "phase1_integrity_exclude": tv | bw,
            "phase1_integrity_exclusion_reason": F.when(tv & bw, "menopause_after_first_cognition_and_backward_transition")
            .when(tv, "menopause_after_first_cognition")
            .when(bw, "post_to_pre_menopause_backward_transition"),
        }
    )


def integrity_cascade(flags: DataFrame) -> DataFrame:
    """Three steps; backward transitions count only when not already
    dropped as temporal violations. One aggregate, then ``stack``."""
    agg = flags.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("temporal_order_violation").alias("t"),
        F.count_if(F.col("any_backward_meno_transition") & ~F.col("temporal_order_violation")).alias("b"),
    )
    return agg.selectExpr(
        """stack(3,
            0, 'Raw person file', cast(0 as bigint), n,
            1, 'Drop menopause-after-first-cognition temporal violations', t, n - t,
            2, 'Drop post-to-pre menopause backward transitions', b, n - t - b
        ) as (step_index, step, n_dropped, n_remaining)"""
    )


def clean_panel(resolved: DataFrame, flags: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Panel rows of persons that pass the integrity checks."""
    return (
        resolved.join(flags.select(spec.id, "phase1_integrity_exclude", "phase1_integrity_exclusion_reason"), spec.id, "left")
        .where(~F.col("phase1_integrity_exclude"))
        .drop("phase1_integrity_exclude")
    )
