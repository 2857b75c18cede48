"""Analysis variables, baseline description and balance (PF10, B1-B12)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_level, fixed, id_window, one_row, recode, thousands
from ..functions.quantile import RankedValues, least_radius
from ..session import materialize
from ..spec import (
    DEFAULT_SPEC,
    EDUCATION_LEVELS,
    MISSING_LEVEL,
    RACE_LEVELS,
    STATUS_LEVELS,
    PanelSpec,
)

MODEL2_COMPLETE = ("cognitive_score", "age_c65", "menopause_group", "race_ethnicity", "birth_year_c10", "education_c12")


def analysis_vars(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, keep_incomplete: bool = False,
                  emulate_na_label: bool = False) -> DataFrame:
    """PF10: model and table variables.

    Race is 'Missing/Unknown' when ``rahispan`` is NULL even if ``raracem``
    is known. A missing birth year gives the cohort level 'Missing'
    ('NAs' with ``emulate_na_label``, as R's paste0 of NA prints).
    """
    hisp, race = F.col("rahispan"), F.col("raracem")
    educ = F.col("raeduc")
    by = F.col("rabyear")
    cf = F.col("baseline_cogfunction")
    na_label = "NAs" if emulate_na_label else MISSING_LEVEL
    d = df.withColumns(
        {
            "cognitive_score": F.col(spec.score),
            "chronological_age": F.col(spec.age),
            "age_c65": F.col(spec.age) - 65,
            "menopause_group": as_level("menopause_group", spec.group_levels),
        }
    )
    d = d.withColumns(
        {
            "age_c65_sq": F.pow(F.col("age_c65"), 2),
            "menopause_group_label": recode("menopause_group", spec.group_labels),
            "race_ethnicity": F.when(hisp == 1, RACE_LEVELS[2])
            .when((hisp == 0) & (race == 1), RACE_LEVELS[0])
            .when((hisp == 0) & (race == 2), RACE_LEVELS[1])
            .when((hisp == 0) & (race == 3), RACE_LEVELS[3])
            .otherwise(RACE_LEVELS[4]),
            "education_years": F.col("raedyrs").cast("double"),
            "education_c12": (F.col("raedyrs") - 12).cast("double"),
            "education_category": F.when(educ == 1, EDUCATION_LEVELS[0])
            .when(educ == 2, EDUCATION_LEVELS[1])
            .when(educ == 3, EDUCATION_LEVELS[2])
            .when(educ == 4, EDUCATION_LEVELS[3])
            .when(educ == 5, EDUCATION_LEVELS[4])
            .otherwise(EDUCATION_LEVELS[5]),
            "birth_year": by.cast("double"),
            "birth_year_c10": (by - 1940) / 10,
            "birth_cohort_decade": F.when(by.isNull(), F.lit(na_label)).otherwise(
                F.concat((F.floor(by / 10) * 10).cast("string"), F.lit("s"))
            ),
            "baseline_cognitive_status": F.when(cf == 1, STATUS_LEVELS[0])
            .when(cf == 2, STATUS_LEVELS[1])
            .when(cf == 3, STATUS_LEVELS[2])
            .otherwise(STATUS_LEVELS[3]),
            "observed_cognition": F.col(spec.score).isNotNull(),
        }
    )
    return d if keep_incomplete else complete_analysis(d)


def complete_analysis(d: DataFrame) -> DataFrame:
    """Rows usable by the models: score, age and a valid group."""
    return d.where(
        F.col("cognitive_score").isNotNull()
        & F.col("chronological_age").isNotNull()
        & F.col("age_c65").isNotNull()
        & F.col("menopause_group").isNotNull()
    )


ANALYSIS_COLUMNS = (
    "cognitive_score", "chronological_age", "age_c65", "age_c65_sq", "menopause_group", "menopause_group_label",
    "race_ethnicity", "education_years", "education_c12", "education_category", "birth_year", "birth_year_c10",
    "birth_cohort_decade", "baseline_cognitive_status", "observed_cognition",
)


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PF5: ``drop_na(cols)`` (NaN counts as missing, as in R)."""
    return df.dropna(subset=list(cols))


def model2_data(analysis: DataFrame) -> DataFrame:
    return complete_cases(analysis, MODEL2_COMPLETE)


def baseline_rows(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """B1: the Time Zero row of each person (first by wave)."""
    return (
        df.where(F.col(spec.wave) == F.col("baseline_wave"))
        .withColumn("_rn", F.row_number().over(id_window(spec)))
        .where("_rn = 1")
        .drop("_rn")
    )


def sample_rows(rows: DataFrame, samples: dict, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Each model's sample against the model-ready panel, from one scan.

    ``samples``: name -> condition of the rows it takes. One aggregate per
    person counts the rows of every sample (no exchange on rows partitioned by
    person), one global aggregate adds them up, and the one row is stacked."""
    conditions = list(samples.values())
    counts = [F.count_if(c).alias(f"_n{i}") for i, c in enumerate(conditions)]
    per_person = rows.groupBy(spec.id).agg(F.count(F.lit(1)).alias("_all"), *counts)
    total = per_person.agg(
        F.sum("_all").alias("_rr"), F.count(F.lit(1)).alias("_rp"),
        *[F.sum(f"_n{i}").alias(f"_r{i}") for i in range(len(conditions))],
        *[F.count_if(F.col(f"_n{i}") > 0).alias(f"_p{i}") for i in range(len(conditions))],
    )
    zero = F.lit(0).cast("long")
    each = F.array(*[
        F.struct(F.lit(name).alias("model"), F.coalesce(f"_r{i}", zero).alias("r"), F.col(f"_p{i}").alias("p"))
        for i, name in enumerate(samples)
    ])
    return total.select("_rr", "_rp", F.explode(each).alias("s")).select(
        "s.model",
        F.col("s.r").alias("n_person_waves"),
        F.col("s.p").alias("n_persons"),
        (F.coalesce("_rr", zero) - F.col("s.r")).alias("exclusions_relative_to_phase2_modelready_rows"),
        (F.col("_rp") - F.col("s.p")).alias("exclusions_relative_to_phase2_modelready_persons"),
    )


def trajectory_summary(analysis: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Data behind the smoothed trajectories, per group."""
    return analysis.groupBy("menopause_group", "menopause_group_label").agg(
        F.count_distinct(spec.id).alias("n_persons"),
        F.count(F.lit(1)).alias("n_person_waves"),
        F.min("chronological_age").alias("min_age"),
        F.max("chronological_age").alias("max_age"),
    )


# ---- B2-B9 balance ------------------------------------------------------------


def all_moments(df: DataFrame, variables: Sequence[str], group: str = "menopause_group") -> DataFrame:
    """Per (variable, group), the NULL group too: n, mean, sample variance and
    sum of the non-NULL values and how many are NULL. One unpivoted aggregate
    that Table 1, the SMDs and ANOVA all read."""
    long = df.select(group, *[F.col(v).cast("double").alias(v) for v in variables]).unpivot(
        [group], list(variables), "variable", "x"
    )
    return long.groupBy("variable", group).agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_samp("x").alias("var"), F.sum("x").alias("sx"),
        F.count_if(F.col("x").isNull()).alias("n_missing"),
    )


def group_moments(df: DataFrame, variables: Sequence[str], group: str = "menopause_group", moments: DataFrame | None = None) -> DataFrame:
    """``all_moments`` of the groups that hold values."""
    m = all_moments(df, variables, group) if moments is None else moments
    return m.where((F.col("n") > 0) & F.col(group).isNotNull())


def overall_moments(moments: DataFrame) -> DataFrame:
    """Per variable: n, mean, sd and n_missing over all groups, combined from
    the groups' moments by deviations from the grand mean."""
    grand = F.try_divide(F.sum("sx").over(Window.partitionBy("variable")), F.sum("n").over(Window.partitionBy("variable")))
    square = F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0)) + F.coalesce(F.col("n") * F.pow(F.col("mean") - F.col("_g"), 2), F.lit(0.0))
    return moments.withColumn("_g", grand).groupBy("variable").agg(
        F.sum("n").alias("n"), F.max("_g").alias("mean"),
        F.sqrt(F.try_divide(F.sum(square), F.when(F.sum("n") > 1, F.sum("n") - 1))).alias("sd"),
        F.sum("n_missing").alias("n_missing"),
    )


def smd_continuous(df: DataFrame, variables: Sequence[str], group: str = "menopause_group", moments: DataFrame | None = None) -> DataFrame:
    """B2: max over pairs of used groups of |m1-m2| / sqrt((v1+v2)/2);
    a pair whose pooled sd is NULL or 0 counts 0; NULL with < 2 groups."""
    m = group_moments(df, variables, group, moments)
    a, b = m.alias("a"), m.alias("b")
    pairs = a.join(b, (F.col("a.variable") == F.col("b.variable")) & (F.col(f"a.{group}") < F.col(f"b.{group}")))
    pooled = F.sqrt((F.col("a.var") + F.col("b.var")) / 2)
    smd = F.when(pooled.isNull() | (pooled == 0), F.lit(0.0)).otherwise(F.abs(F.col("a.mean") - F.col("b.mean")) / pooled)
    best = pairs.groupBy(F.col("a.variable").alias("variable")).agg(F.max(smd).alias("max_pairwise_smd"))
    names = df.sparkSession.createDataFrame([(v,) for v in variables], "variable string")
    return names.join(best, "variable", "left")


def categorical_levels(df: DataFrame, variables: Sequence[str], declared: dict, groups: Sequence[str],
                       group: str = "menopause_group") -> DataFrame:
    """(variable, level) x group counts, zero-filled, one column per
    group level. NULL is the level 'Missing', which every variable has
    (R's ``fct_na_value_to_level``); declared but unused levels count 0."""
    spark = df.sparkSession
    long = df.select(group, *[F.coalesce(F.col(v).cast("string"), F.lit(MISSING_LEVEL)).alias(v) for v in variables]).unpivot(
        [group], list(variables), "variable", "level"
    )
    groups = list(groups)
    counts = long.where(F.col(group).isNotNull()).groupBy("variable", "level").pivot(group, groups).agg(F.count(F.lit(1)))
    rows = []
    for v in variables:
        for lv in list(declared.get(v, ())) + [MISSING_LEVEL]:
            rows.append((v, lv))
    scaffold = spark.createDataFrame(rows, "variable string, level string")
    for g in groups:
        scaffold = scaffold.withColumn(g, F.lit(0).cast("long"))
    both = counts.unionByName(scaffold).groupBy("variable", "level").agg(
        *[F.sum(F.coalesce(F.col(f"`{g}`"), F.lit(0))).cast("long").alias(g) for g in groups]
    )
    return both


def smd_categorical(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per (variable, level), the max pairwise SMD of the level
    indicator between used groups: |p1-p2| / sqrt((p1q1+p2q2)/2), 0 when
    the pooled variance is 0; per variable the max over levels."""
    per_var = Window.partitionBy("variable")
    d = counts
    for i, g in enumerate(groups):
        d = d.withColumn(f"_n{i}", F.sum(F.col(f"`{g}`")).over(per_var))
    smds = []
    for i in range(len(groups)):
        for j in range(i + 1, len(groups)):
            p1 = F.col(f"`{groups[i]}`") / F.col(f"_n{i}")
            p2 = F.col(f"`{groups[j]}`") / F.col(f"_n{j}")
            pv = (p1 * (1 - p1) + p2 * (1 - p2)) / 2
            val = F.when(pv == 0, F.lit(0.0)).otherwise(F.abs(p1 - p2) / F.sqrt(pv))
            smds.append(F.when((F.col(f"_n{i}") > 0) & (F.col(f"_n{j}") > 0), val))
    best = F.greatest(*smds) if len(smds) > 1 else (smds[0] if smds else F.lit(None).cast("double"))
    d = d.withColumn("level_pairwise_smd", best)
    d = d.withColumn("max_pairwise_smd", F.max("level_pairwise_smd").over(per_var))
    return d.select("variable", "level", "level_pairwise_smd", "max_pairwise_smd")


def anova_stats(m: DataFrame, group: str = "menopause_group") -> DataFrame:
    """One-way ANOVA F and degrees of freedom from group moments."""
    whole = Window.partitionBy("variable")  # a row per group: a handful
    grand = F.sum("sx").over(whole) / F.sum("n").over(whole)
    g = m.withColumn("grand", grand).groupBy("variable").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n_total"),
        # between groups: deviations from the grand mean, which no digits cancel from
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("ssb"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("ssw"),
    )
    ssb = F.col("ssb")
    df1 = F.col("k") - 1
    df2 = F.col("n_total") - F.col("k")
    return g.select(
        "variable",
        (F.try_divide(ssb / df1, F.col("ssw") / df2)).alias("f_statistic"),
        df1.cast("long").alias("df1"),
        df2.cast("long").alias("df2"),
    ).where(F.col("df1") >= 1)


def chisq_stats(counts: DataFrame, groups: Sequence[str], emulate_empty_levels: bool = True) -> DataFrame:
    """Pearson chi-square on the level x group table; Yates' correction
    on 2x2 only. As in the reference, a table with an empty level or group
    has no statistic (NULL); without ``emulate_empty_levels`` empty rows and
    columns are dropped first."""
    per_var = Window.partitionBy("variable")
    d = counts.withColumn("_row", sum((F.col(f"`{g}`") for g in groups), F.lit(0)))
    for i, g in enumerate(groups):
        d = d.withColumn(f"_c{i}", F.sum(F.col(f"`{g}`")).over(per_var))
    d = d.withColumn("_N", F.sum("_row").over(per_var))
    d = d.withColumn("_R", F.count_if(F.col("_row") > 0).over(per_var))
    d = d.withColumn("_C", sum((F.when(F.col(f"_c{i}") > 0, 1).otherwise(0) for i in range(len(groups))), F.lit(0)))
    d = d.withColumn("_E", F.count_if(F.col("_row") == 0).over(per_var))
    yates = (F.col("_R") == 2) & (F.col("_C") == 2)
    terms = []
    for i, g in enumerate(groups):
        e = F.col("_row") * F.col(f"_c{i}") / F.col("_N")
        dev = F.abs(F.col(f"`{g}`") - e)
        dev = F.when(yates, dev - F.least(F.lit(0.5), dev)).otherwise(dev)
        terms.append(F.when((F.col("_row") > 0) & (F.col(f"_c{i}") > 0), dev * dev / e).otherwise(F.lit(0.0)))
    d = d.withColumn("_cell", sum(terms[1:], terms[0]))
    out = d.groupBy("variable").agg(
        F.sum("_cell").alias("chi_square"),
        ((F.max("_R") - 1) * (F.max("_C") - 1)).cast("long").alias("df"),
        (F.max("_E") + len(groups) - F.max("_C")).alias("_empty"),
    )
    if emulate_empty_levels:
        out = out.withColumn("chi_square", F.when(F.col("_empty") == 0, F.col("chi_square")))
    return out.drop("_empty").where(F.col("df") >= 1)


# ---- B6-B9 Table 1 and SMD diagnostics ------------------------------------------

def format_p(c) -> F.Column:
    """F8: '' for NULL/NaN, '<0.001', else three decimals."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.isNull() | F.isnan(x), F.lit("")).when(x < 0.001, F.lit("<0.001")).otherwise(fixed(x, 3))


format_smd = format_p


def format_n_pct(n, denom) -> F.Column:
    pct = fixed(F.col(n) * 100.0 / F.col(denom), 1) if isinstance(n, str) else fixed(n * 100.0 / denom, 1)
    nn = F.col(n) if isinstance(n, str) else n
    dd = F.col(denom) if isinstance(denom, str) else denom
    return F.when(dd.isNull() | (dd == 0), F.lit("")).otherwise(F.concat(thousands(nn), F.lit(" ("), pct, F.lit("%)")))


def format_mean_sd(mean, sd, n) -> F.Column:
    m, s, k = (F.col(x) if isinstance(x, str) else x for x in (mean, sd, n))
    return F.when(k.isNull() | (k == 0), F.lit("")).otherwise(
        F.concat(fixed(m, 2), F.lit(" ("), F.coalesce(fixed(s, 2), F.lit("NA")), F.lit(")"))
    )


def continuous_table(base: DataFrame, covariates, groups: Sequence[str], labels: dict, group: str = "menopause_group",
                     moments: DataFrame | None = None) -> DataFrame:
    """Mean (SD) overall and per group, missing count, ANOVA F, SMD, all
    from the group moments (one scan, or ``moments`` as given)."""
    from ..functions.dist import f_pvalue

    variables = [v for v, _ in covariates]
    moments = all_moments(base, variables, group) if moments is None else moments
    ov = overall_moments(moments)
    gs = moments.where(F.col(group).isNotNull()).withColumn("_s", format_mean_sd("mean", F.sqrt("var"), "n"))
    wide = gs.groupBy("variable").pivot(group, list(groups)).agg(F.first("_s"))
    m = group_moments(base, variables, group, moments)
    stats = anova_stats(m, group).withColumn("p", f_pvalue("f_statistic", "df1", "df2"))
    smd = smd_continuous(base, variables, group, moments)
    lab = base.sparkSession.createDataFrame([(v, l, i) for i, (v, l) in enumerate(covariates)], "variable string, Characteristic string, _i int")
    d = lab.join(ov, "variable", "left").join(wide, "variable", "left").join(stats.select("variable", "p"), "variable", "left").join(smd, "variable", "left")
    return d.select(
        "variable",
        (F.col("_i") + 1).alias("row_order"),
        "Characteristic",
        F.lit("Mean (SD)").alias("Level"),
        format_mean_sd("mean", "sd", "n").alias("Overall"),
        *[F.coalesce(F.col(f"`{g}`"), F.lit("")).alias(labels[g]) for g in groups],
        thousands("n_missing").alias("Missing"),
        format_p("p").alias("P value"),
        format_smd("max_pairwise_smd").alias("Max pairwise SMD"),
    )


def categorical_table(base: DataFrame, covariates, declared: dict, groups: Sequence[str], labels: dict,
                      group: str = "menopause_group", emulate_empty_levels: bool = True,
                      counts: DataFrame | None = None) -> DataFrame:
    """N (%) per level overall and per group; chi-square p and the
    covariate's max SMD on the first level only; empty levels 0 (0.0%)."""
    from ..functions.dist import chisq_pvalue

    variables = [v for v, _ in covariates]
    if counts is None:
        counts = categorical_levels(base, variables, declared, groups, group)
    per_var = Window.partitionBy("variable")
    d = counts.withColumn("_row", sum((F.col(f"`{g}`") for g in groups), F.lit(0)))
    for i, g in enumerate(groups):
        d = d.withColumn(f"_d{i}", F.sum(F.col(f"`{g}`")).over(per_var))
    d = d.withColumn("_total", F.sum("_row").over(per_var))
    # level order: declared order, else sorted, 'Missing' last
    order_map = F.create_map(*[F.lit(x) for v, lv in declared.items() for i, l in enumerate(lv) for x in (f"{v}\u0001{l}", i)])
    pos = F.coalesce(
        F.try_element_at(order_map, F.concat(F.col("variable"), F.lit("\u0001"), F.col("level"))),
        F.when(F.col("level") == MISSING_LEVEL, F.lit(10**6)),
    )
    d = d.withColumn("_pos", pos)
    rank_w = Window.partitionBy("variable").orderBy(F.col("_pos").asc_nulls_first(), F.col("level"))
    d = d.withColumn("_lv", F.row_number().over(rank_w))
    smd = smd_categorical(counts, groups)
    chi = chisq_stats(counts, groups, emulate_empty_levels).withColumn("p", chisq_pvalue("chi_square", "df"))
    lab = base.sparkSession.createDataFrame([(v, l, i) for i, (v, l) in enumerate(covariates)], "variable string, Characteristic string, _i int")
    d = d.join(smd, ["variable", "level"], "left").join(chi.select("variable", "p"), "variable", "left").join(lab, "variable", "left")
    first = F.col("_lv") == 1
    return d.select(
        "variable",
        (F.col("_i") * 100 + F.col("_lv") + 100).alias("row_order"),
        "Characteristic",
        F.col("level").alias("Level"),
        format_n_pct(F.col("_row"), F.col("_total")).alias("Overall"),
        *[format_n_pct(F.col(f"`{g}`"), F.col(f"_d{i}")).alias(labels[g]) for i, g in enumerate(groups)],
        F.lit("").alias("Missing"),
        F.when(first, format_p("p")).otherwise(F.lit("")).alias("P value"),
        F.when(first, format_smd("max_pairwise_smd")).otherwise(F.lit("")).alias("Max pairwise SMD"),
    )


def n_row(base: DataFrame, groups: Sequence[str], labels: dict, group: str = "menopause_group") -> DataFrame:
    c = base.groupBy().pivot(group, list(groups)).agg(F.count(F.lit(1)))
    t = base.agg(F.count(F.lit(1)).alias("_n"))
    c = one_row(c, t)
    return c.select(
        F.lit(None).cast("string").alias("variable"),
        F.lit(0).alias("row_order"),
        F.lit("N").alias("Characteristic"),
        F.lit("").alias("Level"),
        thousands("_n").alias("Overall"),
        *[thousands(F.coalesce(F.col(f"`{g}`"), F.lit(0))).alias(labels[g]) for g in groups],
        F.lit("").alias("Missing"),
        F.lit("").alias("P value"),
        F.lit("").alias("Max pairwise SMD"),
    )


def smd_diagnostics(base: DataFrame, continuous, categorical, declared: dict, groups: Sequence[str],
                    group: str = "menopause_group", moments: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Continuous and per-level categorical SMDs in one table."""
    cont = smd_continuous(base, [v for v, _ in continuous], group, moments)
    labels = base.sparkSession.createDataFrame(list(continuous) + list(categorical), "variable string, label string")
    c1 = cont.join(labels, "variable", "left").select(
        "variable", "label", F.lit("continuous").alias("covariate_type"), F.lit(None).cast("string").alias("level"),
        F.lit(None).cast("double").alias("level_pairwise_smd"), "max_pairwise_smd",
    )
    if counts is None:
        counts = categorical_levels(base, [v for v, _ in categorical], declared, groups, group)
    c2 = smd_categorical(counts, groups).join(labels, "variable", "left").select(
        "variable", "label", F.lit("categorical").alias("covariate_type"), "level", "level_pairwise_smd", "max_pairwise_smd",
    )
    return c1.unionByName(c2)


# ---- B11 LOESS trajectories -----------------------------------------------------

def _det3(a, b, c, d, e, f, g, h, i):
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def _loess_points(df: DataFrame, x: str, y: str, group: str, x_min: float, y_limits) -> DataFrame:
    """(g, x, n, sy): the points inside the plot limits, equal x together."""
    pts = df.select(F.col(group).alias("g"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("g").isNotNull()
        & (F.col("x") >= x_min) & (F.col("y") >= y_limits[0]) & (F.col("y") <= y_limits[1])
    )
    return pts.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"))


def local_quadratic(points: DataFrame, at: list[tuple], span: float) -> DataFrame:
    """(g, i, x0, fit, slope): the local quadratic (tricube weights over the
    nearest floor(span * n) points) and its slope at given (g, i, x0, need).

    ``at`` is bounded (grid points or cell borders), so the points meet it by a
    broadcast join and are summed where they are: no row is shuffled and no
    order is needed. NULL where fewer than 3 distinct x have weight."""
    spark = points.sparkSession
    where = F.broadcast(spark.createDataFrame(at, "g string, i int, x0 double, need long"))
    pairs = points.join(where, "g").withColumn("d", F.col("x") - F.col("x0"))
    radius = least_radius(pairs, ("g", "i"), F.abs("d"), F.col("n"), F.col("need"))
    u = F.abs("d") / (F.col("radius") * max(1.0, span))
    near = pairs.join(F.broadcast(radius), ["g", "i"]).withColumn("w", F.when(u < 1, F.pow(1 - F.pow(u, 3), 3)).otherwise(0.0))
    aggs = [F.sum(F.col("w") * F.col("n") * F.pow(F.col("d"), k)).alias(f"S{k}") for k in range(5)]
    aggs += [F.sum(F.col("w") * F.col("sy") * F.pow(F.col("d"), k)).alias(f"T{k}") for k in range(3)]
    S, T_ = [F.col(f"S{k}") for k in range(5)], [F.col(f"T{k}") for k in range(3)]
    det = _det3(S[0], S[1], S[2], S[1], S[2], S[3], S[2], S[3], S[4])
    fit = F.try_divide(_det3(T_[0], S[1], S[2], T_[1], S[2], S[3], T_[2], S[3], S[4]), det)
    slope = F.try_divide(_det3(S[0], T_[0], S[2], S[1], T_[1], S[3], S[2], T_[2], S[4]), det)
    return near.groupBy("g", "i", "x0").agg(*aggs).select("g", "i", "x0", fit.alias("fit"), slope.alias("slope"))


def cell_borders(points: DataFrame, span: float, cell: float = 0.2, margin: float = 0.1) -> dict[str, list[float]]:
    """The borders of each group's cells: a box around its x, ``margin`` wider
    on either side, cut at the middle of a cell's points while the cell holds
    more than span * cell of all; so their number doesn't grow with the points.

    A level of cuts is one search of ranks for all groups."""
    values = RankedValues(points, ["g"], "x", count="n")
    limits = points.groupBy("g").agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()  # one row per group
    borders, cells = {}, []
    for r in limits:
        wide = max(r["hi"] - r["lo"], 1e-10 * max(abs(r["lo"]), abs(r["hi"])) + 1e-30) * margin
        borders[r["g"]] = [r["lo"] - wide, r["hi"] + wide]
        cells.append((r["g"], 0, r["n"] - 1, r["lo"] - wide, r["hi"] + wide, math.floor(r["n"] * span * cell)))
    spark = points.sparkSession
    while cells := [c for c in cells if c[2] - c[1] + 1 > c[5]]:
        wanted = [(c[0], k, (c[1] + c[2]) // 2 + side, side) for k, c in enumerate(cells) for side in (0, 1)]
        found = values.at(spark.createDataFrame(wanted, "g string, k int, rank long, side int")).collect()  # two rows per cell
        value = {(r["k"], r["side"]): (r["_x"], r["_upto"]) for r in found}
        ahead = []
        for k, (g, first, last, lo, hi, most) in enumerate(cells):
            (a, upto), (b, _) = value[k, 0], value.get((k, 1), value[k, 0])
            cut = (a + b) / 2
            left = upto - 1  # the last rank not above the cut
            if lo < cut < hi and first <= left < last:
                borders[g].append(cut)
                ahead += [(g, first, left, lo, cut, most), (g, left + 1, last, cut, hi, most)]
        cells = ahead
    return {g: sorted(b) for g, b in borders.items()}


def loess_curve(df: DataFrame, x: str = "chronological_age", y: str = "cognitive_score", group: str = "menopause_group",
                span: float = 0.75, grid: int = 80, x_min: float = 50.0, y_limits=(0.0, 27.0), surface: str = "exact") -> DataFrame:
    """The local quadratic fit at ``grid`` points spanning each group's x
    range, over the x as they are. Points outside the plot limits are removed
    before smoothing (x >= ``x_min``, y within ``y_limits``).

    ``surface``: "exact" fits at each grid point; "interpolate" fits value and
    slope at the borders of a few cells of x (``cell_borders``) and blends the
    two borders around a grid point by the cubic that has both values and
    slopes, as R's default does."""
    points = materialize(_loess_points(df, x, y, group, x_min, y_limits))
    limits = points.groupBy("g").agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()  # one row per group
    need = {r["g"]: math.floor(r["n"] * span) for r in limits}
    steps = [(r["g"], i, r["lo"] + i * (r["hi"] - r["lo"]) / (grid - 1), need[r["g"]]) for r in limits for i in range(grid)]
    out = [F.col("g").alias(group), F.col("i").alias("grid_index"), F.col("x0").alias(x), "fit"]
    if surface == "exact":
        return local_quadratic(points, steps, span).select(*out)
    borders = cell_borders(points, span)
    at = local_quadratic(points, [(g, i, b, need[g]) for g, bs in borders.items() for i, b in enumerate(bs)], span)
    cell = [(g, i, x0, max(k for k, b in enumerate(borders[g][:-1]) if b <= x0)) for g, i, x0, _ in steps]
    spot = points.sparkSession.createDataFrame(cell, "g string, i int, x0 double, k int")
    left = at.select("g", F.col("i").alias("k"), F.col("x0").alias("a"), F.col("fit").alias("fa"), F.col("slope").alias("sa"))
    right = at.select("g", (F.col("i") - 1).alias("k"), F.col("x0").alias("b"), F.col("fit").alias("fb"), F.col("slope").alias("sb"))
    both = spot.join(left, ["g", "k"]).join(right, ["g", "k"])
    w = F.col("b") - F.col("a")
    t = (F.col("x0") - F.col("a")) / w
    blend = ((1 - t) * (1 - t) * (1 + 2 * t) * F.col("fa") + t * t * (3 - 2 * t) * F.col("fb")
             + t * (1 - t) * (1 - t) * w * F.col("sa") - t * t * (1 - t) * w * F.col("sb"))
    return both.withColumn("fit", blend).select(*out)


def loess_band(df: DataFrame, x: str = "chronological_age", y: str = "cognitive_score", group: str = "menopause_group",
               span: float = 0.75, grid: int = 80, x_min: float = 50.0, y_limits=(0.0, 27.0), bin_width: float = 1.0) -> DataFrame:
    """The exact curve with its confidence band. The band needs the whole
    smoother, a matrix over the distinct x, so here (and only here) x is rounded
    to ``bin_width`` (whole years leave integer ages as they are): the work is
    bounded by the range of x whatever the number of rows. The band is R's with
    exact statistics: with M = (I-L)(I-L)'
    for the smoother L, s^2 = RSS / tr M, se = s * ||smoother row||, and a t
    quantile with (tr M)^2 / tr M^2 degrees of freedom.
    """
    from ..functions.dist import t975

    xv = F.round(F.col(x).cast("double") / bin_width) * bin_width
    pts = df.select(F.col(group).alias("g"), xv.alias("x"), F.col(y).cast("double").alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("g").isNotNull()
        & (F.col("x") >= x_min) & (F.col("y") >= y_limits[0]) & (F.col("y") <= y_limits[1])
    )
    hist = pts.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"))
    per_g = hist.groupBy("g").agg(F.sum("n").alias("n_total"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    grid_pts = per_g.select(
        "g", "n_total", F.posexplode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("grid_index", "_k"),
        "lo", "hi",
    ).select("g", "n_total", "grid_index", (F.col("lo") + F.col("grid_index") * (F.col("hi") - F.col("lo")) / (grid - 1)).alias("x0"))
    # fitted values at each distinct x too (for the residual scale)
    obs_pts = hist.join(per_g.select("g", "n_total"), "g").select("g", "n_total", F.lit(-1).alias("grid_index"), F.col("x").alias("x0"))
    at = grid_pts.unionByName(obs_pts)
    pairs = at.join(hist, "g")
    d = F.col("x") - F.col("x0")
    pairs = pairs.withColumn("d", d).withColumn("ad", F.abs(d))
    w_near = Window.partitionBy("g", "grid_index", "x0").orderBy("ad").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    q = F.floor(F.col("n_total") * span)
    pairs = pairs.withColumn("_cum", F.sum("n").over(w_near))
    per_pt = Window.partitionBy("g", "grid_index", "x0")
    pairs = pairs.withColumn("h", F.min(F.when(F.col("_cum") >= q, F.col("ad"))).over(per_pt) * F.greatest(F.lit(1.0), F.lit(span)))
    u = F.col("ad") / F.col("h")
    pairs = pairs.withColumn("w", F.when(u < 1, F.pow(1 - F.pow(u, 3), 3)).otherwise(F.lit(0.0)))
    aggs = [F.sum(F.col("w") * F.col("n") * F.pow(F.col("d"), k)).alias(f"S{k}") for k in range(5)]
    aggs += [F.sum(F.col("w") * F.col("sy") * F.pow(F.col("d"), k)).alias(f"T{k}") for k in range(3)]
    aggs += [F.sum(F.col("w") * F.col("w") * F.col("n") * F.pow(F.col("d"), k)).alias(f"U{k}") for k in range(5)]
    m = pairs.groupBy("g", "grid_index", "x0").agg(*aggs)
    S = [F.col(f"S{k}") for k in range(5)]
    T_ = [F.col(f"T{k}") for k in range(3)]
    det = _det3(S[0], S[1], S[2], S[1], S[2], S[3], S[2], S[3], S[4])
    # try_divide: a degenerate neighbourhood (fewer than 3 distinct x with
    # weight) has det = 0 and yields NULL instead of failing the job
    fit = F.try_divide(_det3(T_[0], S[1], S[2], T_[1], S[2], S[3], T_[2], S[3], S[4]), det)
    # first row of A^-1 (cofactors of the symmetric A)
    c0 = F.try_divide(S[2] * S[4] - S[3] * S[3], det)
    c1 = F.try_divide(-(S[1] * S[4] - S[2] * S[3]), det)
    c2 = F.try_divide(S[1] * S[3] - S[2] * S[2], det)
    U = [F.col(f"U{k}") for k in range(5)]
    l2 = (c0 * c0 * U[0] + c1 * c1 * U[2] + c2 * c2 * U[4] + 2 * c0 * c1 * U[1] + 2 * c0 * c2 * U[2] + 2 * c1 * c2 * U[3])
    m = m.withColumns({"fit": fit, "_l2": l2, "_lii": c0})
    obs = m.where(F.col("grid_index") < 0).join(hist.withColumnRenamed("x", "x0"), ["g", "x0"])
    rss = obs.groupBy("g").agg(
        F.sum(F.col("syy") - 2 * F.col("fit") * F.col("sy") + F.col("n") * F.col("fit") * F.col("fit")).alias("_rss")
    )
    # the smoother's rows at the observed x: l(i, j) is the weight of one
    # observation at x_j in the fit at x_i
    at_obs = m.where(F.col("grid_index") < 0).select("g", "x0", c0.alias("_c0"), c1.alias("_c1"), c2.alias("_c2"))
    weight = F.col("w") * (F.col("_c0") + F.col("_c1") * F.col("d") + F.col("_c2") * F.col("d") * F.col("d"))
    smoother = pairs.where(F.col("grid_index") < 0).join(at_obs, ["g", "x0"]).select("g", F.col("x0").alias("i"), F.col("x").alias("j"), "n", weight.alias("l"))
    left, right = smoother.alias("a"), smoother.alias("b")
    product = left.join(right, ["g", "j"]).groupBy("g", F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(
        F.sum(F.col("a.n") * F.col("a.l") * F.col("b.l")).alias("h")
    )
    there = smoother.select("g", "i", "j", F.col("l").alias("l_ij"), F.col("n").alias("n_j"))
    back = smoother.select("g", F.col("i").alias("j"), F.col("j").alias("i"), F.col("l").alias("l_ji"), F.col("n").alias("n_i"))
    both = product.join(there, ["g", "i", "j"]).join(back, ["g", "i", "j"]).withColumn("m", F.col("h") - F.col("l_ij") - F.col("l_ji"))
    same = F.col("i") == F.col("j")
    traces = both.groupBy("g").agg(
        F.sum(F.when(same, F.col("n_i") * F.col("l_ij"))).alias("_enp"),
        F.sum(F.when(same, F.col("n_i") * (1 + F.col("m")))).alias("_d1"),
        (F.sum(F.col("n_i") * F.col("n_j") * F.col("m") * F.col("m")) + F.sum(F.when(same, F.col("n_i") * (1 + 2 * F.col("m"))))).alias("_d2"),
    )
    scale = rss.join(traces, "g").withColumn("_s", F.sqrt(F.try_divide("_rss", "_d1"))).withColumn("_df", F.try_divide(F.col("_d1") * F.col("_d1"), F.col("_d2")))
    curve = m.where(F.col("grid_index") >= 0).join(scale.select("g", "_s", "_enp", t975("_df").alias("_t")), "g")
    se = F.col("_s") * F.sqrt(F.col("_l2"))
    return curve.select(
        F.col("g").alias(group), "grid_index", F.col("x0").alias(x), "fit", se.alias("std_error"),
        (F.col("fit") - F.col("_t") * se).alias("conf_low"), (F.col("fit") + F.col("_t") * se).alias("conf_high"),
        F.col("_enp").alias("equivalent_parameters"),
    )
