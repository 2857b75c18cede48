"""Standardized predictions and contrasts from a fitted model (V1-V7).

Predictions are standardized over one row per person: with group and age
fixed for everyone, each design column's average is the average of its
person coefficient, so one aggregate of person covariates (proportions of
each race level, mean birth cohort, mean education) gives every average
design vector. The rows never reach the driver; only those ~10 averages do.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dist
from ..functions.exprs import id_window
from ..spec import DEFAULT_SPEC, PanelSpec
from .design import Design


def covariate_distribution(model_rows: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """V1: the first model row of each person (by wave)."""
    return (
        model_rows.withColumn("_rn", F.row_number().over(id_window(spec)))
        .where("_rn = 1")
        .select(spec.id, "race_ethnicity", "birth_year_c10", "education_c12")
    )


def person_factors(column) -> tuple:
    """What a design column takes from the person, group aside."""
    return tuple((v, lv) for v, lv in column.factors if v != "menopause_group")


def covariate_means(cov: DataFrame, design: Design) -> dict:
    """Average of what every design column takes from the person, in one
    aggregate: a level's share, a covariate's mean, and for columns with
    several of them the mean of their product."""
    keys = list(dict.fromkeys(k for c in design.columns if (k := person_factors(c))))
    if not keys:
        return {}

    def product(factors):
        out = F.lit(1.0)
        for v, lv in factors:
            out = out * (F.col(v).cast("double") if lv is None else (F.col(v) == lv).cast("double"))
        return out

    row = cov.agg(*[F.avg(product(k)).alias(f"_m{i}") for i, k in enumerate(keys)]).first()
    return {k: float(row[f"_m{i}"]) for i, k in enumerate(keys)}


def average_design(design: Design, means: dict, group: str, age: float) -> np.ndarray:
    """V2: the design row averaged over persons with group and age set."""
    L = np.zeros(design.p)
    for j, c in enumerate(design.columns):
        person = person_factors(c)
        value = (age - 65.0) ** c.power * (means[person] if person else 1.0)
        L[j] = value if all(lv == group for v, lv in c.factors if v == "menopause_group") else 0.0
    return L


def linear_prediction(beta, vcov, L):
    """V3: L b, sqrt(L V L'), normal 95% interval."""
    est = float(L @ beta)
    se = math.sqrt(max(float(L @ vcov @ L), 0.0))
    return est, se, est - dist.Z975 * se, est + dist.Z975 * se


def _fmt(x):
    from decimal import ROUND_HALF_UP, Decimal

    return str(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def marginal_means(spark: SparkSession, fit, design: Design, means: dict, ages: Sequence[float], groups: Sequence[str],
                   labels: dict) -> DataFrame:
    """V4: predictions for every (age, group) with their L vectors."""
    rows = []
    for a in ages:
        for g in groups:
            L = average_design(design, means, g, a)
            est, se, lo, hi = linear_prediction(fit.beta, fit.vcov, L)
            rows.append((float(a), g, labels[g], est, se, lo, hi, f"{_fmt(est)} [{_fmt(lo)}, {_fmt(hi)}]", [float(x) for x in L]))
    return spark.createDataFrame(
        rows,
        "chronological_age double, menopause_group string, menopause_group_label string, predicted_score double, "
        "std_error double, conf_low double, conf_high double, predicted_score_ci string, L array<double>",
    )


def average_design_table(spark: SparkSession, design: Design, means: dict, ages, groups) -> DataFrame:
    """V2 in long form: (age, group, term index, term, value)."""
    rows = []
    for a in ages:
        for g in groups:
            L = average_design(design, means, g, a)
            rows += [(float(a), g, j, design.columns[j].name, float(L[j])) for j in range(design.p)]
    return spark.createDataFrame(rows, "chronological_age double, menopause_group string, term_index int, term string, value double")


def clinical_contrasts(spark: SparkSession, fit, design: Design, means: dict, ages, compare: Sequence[str], reference: str,
                       labels: dict) -> DataFrame:
    """V5: difference of each chosen group from the reference at each age."""
    rows = []
    for a in ages:
        Lr = average_design(design, means, reference, a)
        ref_est = float(Lr @ fit.beta)
        for g in compare:
            L = average_design(design, means, g, a)
            est_g, _, lo_g, hi_g = linear_prediction(fit.beta, fit.vcov, L)
            d, se, lo, hi = linear_prediction(fit.beta, fit.vcov, L - Lr)
            p = dist.norm_sf2(d / se) if se > 0 else float("nan")
            ci = lambda x, low, high: f"{_fmt(x)} [{_fmt(low)}, {_fmt(high)}]"
            rows.append((float(a), labels[reference], labels[g], ref_est, est_g, d, se, lo, hi, p,
                         _fmt(ref_est), ci(est_g, lo_g, hi_g), ci(d, lo, hi)))
    from .describe import format_p

    rows.sort(key=lambda r: (r[0], r[2]))
    out = spark.createDataFrame(
        rows,
        "age double, reference_group string, comparison_group string, reference_predicted_score double, "
        "comparison_predicted_score double, absolute_difference double, std_error double, conf_low double, "
        "conf_high double, p_value double, reference_predicted_score_ci string, comparison_predicted_score_ci string, "
        "absolute_difference_ci string",
    )
    return out.withColumn("p_value_formatted", format_p("p_value"))


def trajectory_range(traj: DataFrame) -> DataFrame:
    """V7."""
    return traj.groupBy("menopause_group_label").agg(
        F.min("predicted_score").alias("min_predicted"), F.max("predicted_score").alias("max_predicted")
    )


def format_contrasts(contrasts: DataFrame) -> DataFrame:
    """The exported contrast table: fixed-point strings with two decimals
    and a formatted p-value (F8)."""
    from ..functions.exprs import fixed
    from .describe import format_p

    return contrasts.select(
        F.col("age").alias("Age"),
        F.col("reference_group").alias("Reference group"),
        F.col("comparison_group").alias("Comparison group"),
        fixed("reference_predicted_score", 2).alias("Reference predicted score"),
        fixed("comparison_predicted_score", 2).alias("Comparison predicted score"),
        fixed("absolute_difference", 2).alias("Absolute difference"),
        F.concat(F.lit("["), fixed("conf_low", 2), F.lit(", "), fixed("conf_high", 2), F.lit("]")).alias("95% CI"),
        format_p("p_value").alias("P value"),
    )
