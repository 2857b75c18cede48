"""Eligibility, Time Zero and the analytic cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import all_true, any_true, count_true, flag_female, id_window, in_set, mode_first, one_row, sorted_unique_join
from ..spec import DEFAULT_SPEC, PREMENOPAUSAL, UNKNOWN_INCONSISTENT, UNKNOWN_TYPE, PanelSpec


def eligibility(clean: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Per-row eligibility flags (three-valued, as in R)."""
    age = F.col(spec.age)
    d = clean.withColumns(
        {
            "is_female": flag_female(spec.female, spec.gender),
            "valid_cognition": F.col(spec.score).isNotNull(),
            "age_eligible": age.isNotNull() & (age >= 50),
            "valid_menopause_exposure": in_set(spec.exposure, spec.valid_groups),
            "natural_menopause_group": in_set(spec.exposure, spec.natural_groups),
        }
    )
    return d.withColumn(
        "eligible_timezero_wave",
        F.col("is_female") & F.col("age_eligible") & F.col("valid_cognition") & F.col("valid_menopause_exposure"),
    )


def cohort_flags(base: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Person flags; sex is the person's first-tie mode (NULL -> false)."""
    flags = base.groupBy(spec.id).agg(
        any_true("valid_menopause_exposure").alias("any_valid_menopause_exposure"),
        any_true("valid_cognition").alias("any_valid_cognitive_assessment"),
        count_true("valid_cognition").alias("n_valid_cognitive_assessments"),
        any_true("eligible_timezero_wave").alias("any_eligible_timezero_wave"),
    )
    female = mode_first(base, [spec.id], "is_female", spec.wave, "person_female")
    return flags.join(female, spec.id, "left").select(
        spec.id,
        F.coalesce("person_female", F.lit(False)).alias("person_female"),
        "any_valid_menopause_exposure",
        "any_valid_cognitive_assessment",
        "n_valid_cognitive_assessments",
        "any_eligible_timezero_wave",
    )


def exposure_availability(base: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Exposure reports per person and the problem class."""
    x = F.col(spec.exposure)
    d = base.groupBy(spec.id).agg(
        any_true("valid_menopause_exposure").alias("any_valid_menopause_exposure"),
        any_true(x == PREMENOPAUSAL).alias("ever_premenopausal"),
        any_true(x == UNKNOWN_TYPE).alias("ever_unknown_type"),
        any_true(x == UNKNOWN_INCONSISTENT).alias("ever_unknown_inconsistent"),
        all_true(x.isNull()).alias("all_meno_combo_missing"),
        sorted_unique_join(spec.exposure, " | ").alias("observed_meno_combo_values"),
    )
    c = {k: F.col(k) for k in ("any_valid_menopause_exposure", "all_meno_combo_missing", "ever_premenopausal", "ever_unknown_type", "ever_unknown_inconsistent")}
    cls = (
        F.when(c["any_valid_menopause_exposure"], "has_valid_exposure")
        .when(c["all_meno_combo_missing"], "all_menopause_combo_missing")
        .when(c["ever_premenopausal"] & ~c["ever_unknown_type"] & ~c["ever_unknown_inconsistent"], "only_premenopausal_or_missing")
        .when(c["ever_unknown_type"] | c["ever_unknown_inconsistent"], "unknown_or_inconsistent_only")
        .otherwise("other_no_valid_exposure")
    )
    return d.withColumn("exposure_problem_class", cls)


def baseline(base: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Time Zero is the first eligible wave; baseline attributes are
    that row's own values (its own exposure-age report, not the mode)."""
    cf = F.col(spec.cogfunction)
    first = (
        base.where(F.col("eligible_timezero_wave"))
        .withColumn("_rn", F.row_number().over(id_window(spec)))
        .where("_rn = 1")
    )
    return first.select(
        spec.id,
        F.col(spec.wave).alias("baseline_wave"),
        F.col(spec.year).alias("baseline_year"),
        F.col(spec.age).alias("baseline_age"),
        F.col(spec.score).alias("baseline_cognition"),
        cf.alias("baseline_cogfunction"),
        (cf == 3).alias("baseline_dementia"),
        F.when(cf == 1, 1).when(cf == 2, 0).when(cf == 3, 0).cast("int").alias("baseline_normal"),
        (cf == 2).alias("baseline_cind"),
        F.col(spec.exposure).alias("menopause_group"),
        F.col(spec.exposure_type).alias("menopause_type"),
        F.col(spec.exposure_age5).alias("menopause_age_category"),
        F.col(spec.exposure_age).alias("baseline_exposure_age"),
        in_set(spec.exposure, spec.natural_groups).alias("natural_menopause_group"),
    )


CASCADE_STEPS = (
    "Start after Phase 1 integrity exclusions",
    "Drop men",
    "Drop women with missing/invalid menopause type-timing exposure",
    "Drop women with zero valid cognitive assessments",
    "Drop women with no eligible Time Zero wave",
    "Drop prevalent dementia at baseline",
)


def cohort_steps(flags: DataFrame, base_line: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Per person, the last cascade step passed (0..5); the sets are nested."""
    dem = base_line.select(spec.id, F.coalesce("baseline_dementia", F.lit(False)).alias("_dem"))
    d = flags.join(dem, spec.id, "left")
    step = (
        F.when(~F.col("person_female"), 0)
        .when(~F.col("any_valid_menopause_exposure"), 1)
        .when(~F.col("any_valid_cognitive_assessment"), 2)
        .when(~F.col("any_eligible_timezero_wave"), 3)
        .when(F.coalesce("_dem", F.lit(False)), 4)
        .otherwise(5)
    )
    return d.select(spec.id, step.alias("last_step_passed"))


def exclusion_cascade(steps: DataFrame, base: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Persons before / dropped / remaining and rows remaining per step.

    Rows per person are counted on the id-partitioned panel, joined to the
    person steps on id, and the whole cascade is one global aggregate
    of conditional sums (no per-step job, no id list on the driver).
    """
    rows = base.groupBy(spec.id).agg(F.count(F.lit(1)).alias("_rows"))
    d = steps.join(rows, spec.id, "left")
    aggs = []
    for s in range(6):
        ge = F.col("last_step_passed") >= s
        aggs.append(F.count_if(ge).alias(f"p{s}"))
        aggs.append(F.coalesce(F.sum(F.when(ge, F.col("_rows"))), F.lit(0)).cast("long").alias(f"r{s}"))
    a = d.agg(*aggs)
    parts = ["0, '{}', cast(null as bigint), cast(0 as bigint), p0, r0".format(CASCADE_STEPS[0])]
    for s in range(1, 6):
        parts.append(f"{s}, '{CASCADE_STEPS[s]}', p{s - 1}, p{s - 1} - p{s}, p{s}, r{s}")
    return a.selectExpr(
        "stack(6, " + ", ".join(parts) + ") as (step_index, step, n_persons_before, n_persons_dropped, n_persons_remaining, n_rows_remaining)"
    )


def baseline_person(base_line: DataFrame, steps: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Time Zero rows of persons who pass every step (semi-join)."""
    return base_line.join(steps.where(F.col("last_step_passed") == 5), spec.id, "left_semi")


def baseline_groups(bperson: DataFrame) -> DataFrame:
    return bperson.groupBy("menopause_group").agg(F.count(F.lit(1)).alias("n_persons"))


BASELINE_CARRY = (
    "baseline_wave", "baseline_year", "baseline_age", "baseline_cognition", "baseline_cogfunction",
    "baseline_normal", "baseline_cind", "menopause_group", "menopause_type", "menopause_age_category",
    "baseline_exposure_age",
)


def analytic_panel(base: DataFrame, bperson: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows from Time Zero on with time since baseline and centred age.
    The baseline natural-group flag is kept as ``baseline_natural_group``."""
    b = bperson.select(spec.id, *BASELINE_CARRY, F.col("natural_menopause_group").alias("baseline_natural_group"))
    d = base.join(b, spec.id, "inner").where(F.col(spec.wave) >= F.col("baseline_wave"))
    return d.withColumns(
        {
            "time_since_baseline_wave": F.col(spec.wave) - F.col("baseline_wave"),
            "time_since_baseline_year": F.col(spec.year) - F.col("baseline_year"),
            "age_centered_65": F.col(spec.age) - 65,
            "post_baseline_valid_cognition": F.col(spec.score).isNotNull(),
        }
    )


def model_ready(allwaves: DataFrame) -> DataFrame:
    return allwaves.where(F.col("post_baseline_valid_cognition"))


def cohort_summary(allwaves: DataFrame, ready: DataFrame, bperson: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """One row; the per-person count distribution is aggregated first,
    so the median sees at most one value per person."""
    per_person = ready.groupBy(spec.id).agg(F.count(F.lit(1)).alias("n"))
    a = allwaves.agg(F.count_distinct(spec.id).alias("n_persons"), F.count(F.lit(1)).alias("n_person_waves_all_post_timezero"))
    r = per_person.agg(
        F.sum("n").cast("long").alias("n_person_waves_valid_cognition"),
        F.avg("n").alias("mean_valid_cognitive_assessments_per_person"),
        F.percentile(F.col("n").cast("double"), 0.5).alias("median_valid_cognitive_assessments_per_person"),
    )
    b = bperson.agg(
        F.count_if(F.col("baseline_normal") == 1).alias("n_baseline_normal"),
        count_true("baseline_cind").alias("n_baseline_cind"),
        F.count_if(F.col("baseline_normal").isNull()).alias("n_baseline_normal_missing"),
    )
    return one_row(a, r, b)
