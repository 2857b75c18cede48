"""Inverse-probability-of-censoring weights."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dist import norm_sf2
from ..functions.exprs import clamp, id_window, one_row
from ..spec import DEFAULT_SPEC, PanelSpec
from .describe import complete_cases
from .integrity import wave_grid
from .logit import LogitModel, NotConverged, Separated, feature, fit_logits  # noqa: F401
from .retention import first_baseline, observed_by_wave

BASELINE_COVARIATES = ("baseline_wave", "menopause_group", "race_ethnicity", "birth_year_c10", "education_c12", "baseline_normal")
DENOMINATOR_TERMS = ("menopause_group", "race_ethnicity", "birth_year_c10", "education_c12", "lag_cognitive_score", "lag_chronological_age")
NUMERATOR_TERMS = ("menopause_group", "race_ethnicity", "birth_year_c10", "education_c12")


def ipcw_panel(model_rows: DataFrame, analysis_all: DataFrame, waves: Column | Sequence[int], spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Grid from Time Zero, baseline covariates, what was observed,
    lags over the grid; at risk = after baseline and observed at the
    previous grid wave (a return after a miss is not at risk)."""
    base = first_baseline(model_rows, BASELINE_COVARIATES, spec)
    grid = wave_grid(base.select(spec.id, "baseline_wave"), "baseline_wave", waves, spec)
    obs = observed_by_wave(analysis_all, base, spec, carry=("cognitive_score", "chronological_age"))
    d = grid.join(base, spec.id, "left").join(obs, [spec.id, spec.wave], "left")
    d = d.withColumns(
        {
            "row_present": F.coalesce("row_present", F.lit(False)),
            "observed_cognition": F.coalesce("observed_cognition", F.lit(False)),
        }
    )
    w = id_window(spec)
    d = d.withColumns(
        {
            "lag_observed_cognition": F.lag("observed_cognition").over(w),
            "lag_cognitive_score": F.lag("cognitive_score").over(w),
            "lag_chronological_age": F.lag("chronological_age").over(w),
        }
    )
    return d.withColumns(
        {
            "at_risk_for_observation": (F.col(spec.wave) > F.col("baseline_wave")) & F.col("lag_observed_cognition"),
            "observed_t": F.col("observed_cognition").cast("int"),
        }
    )


def ipcw_risk_set(ipanel: DataFrame) -> DataFrame:
    """At-risk grid rows with complete model terms."""
    return complete_cases(ipanel.where(F.col("at_risk_for_observation")), ("observed_t",) + DENOMINATOR_TERMS)


def bound_probability(c, eps: float = 1e-4):
    return clamp(c, eps, 1 - eps)


def cumulative_weights(ipanel: DataFrame, predictions: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """factor = stabilized weight where at risk and observed, else 1
    (NULL -> 1); running product over all grid waves of the person."""
    d = ipanel.join(predictions.select(spec.id, spec.wave, "stabilized_transition_weight"), [spec.id, spec.wave], "left")
    f = F.when(F.col("at_risk_for_observation") & F.col("observed_cognition"), F.col("stabilized_transition_weight")).otherwise(F.lit(1.0))
    d = d.withColumn("transition_weight_for_observed_outcome", F.coalesce(f, F.lit(1.0)))
    w = id_window(spec).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.withColumn("sw_cumulative", F.product("transition_weight_for_observed_outcome").over(w))


def attach_weights(model_rows: DataFrame, weights: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Model rows get their grid weight; rows outside the grid get 1."""
    return model_rows.join(weights.select(spec.id, spec.wave, "sw_cumulative"), [spec.id, spec.wave], "left").withColumn(
        "sw_cumulative", F.coalesce("sw_cumulative", F.lit(1.0))
    )


def truncate_weights(df: DataFrame, lo: float, hi: float, col: str = "sw_cumulative", out: str = "sw_truncated") -> DataFrame:
    """Clamp at given bounds (the bounds are two numbers computed by
    ``exact_quantiles`` on the same rows)."""
    return df.withColumn(out, clamp(col, lo, hi))


# ---- M14-M16 observation models -------------------------------------------------

def given_logit(intercept: float, coefficients: dict):
    """A fitted model (as ``fit_logit`` returns it) with given coefficients
    by column name."""
    return LogitModel(intercept, list(coefficients.values())), list(coefficients), [feature(n) for n in coefficients]


def save_logit(spark, fitted, name: str, path: str) -> None:
    """IO9: a logistic model as its coefficient table, in term order."""
    table = logit_coefficients(spark, fitted, name)
    order = F.array_position(F.lit(["(Intercept)", *fitted[1]]), F.col("term")).alias("position")
    table.select("*", order).coalesce(1).write.mode("overwrite").parquet(path)


def load_logit(spark, path: str):
    """The model that ``save_logit`` wrote; it predicts and lists its
    coefficients like the fitted one."""
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["position"])
    first, *rest = rows
    names = [r["term"] for r in rest]
    variance = np.diag([r["std.error"] ** 2 for r in rows])
    return LogitModel(first["estimate"], [r["estimate"] for r in rest], variance), names, [feature(n) for n in names]


def fit_logit(risk: DataFrame, terms: Sequence[str], label: str = "observed_t", max_iter: int = 50):
    """One binomial model with logit link (``logit.fit_logits``)."""
    return fit_logits(risk, {label: terms}, label, max_iter)[label]


def logit_coefficients(spark, fitted, name: str) -> DataFrame:
    """Estimate, se, z, p; the intercept comes first as in R."""
    model, names, _ = fitted
    rows = []
    for term, estimate, se in zip(["(Intercept)", *names], [model.intercept, *model.coefficients], model.std_errors):
        z = float(estimate) / se if se else float("nan")
        rows.append((name, term, float(estimate), float(se), z, norm_sf2(z)))
    return spark.createDataFrame(rows, "model string, term string, estimate double, `std.error` double, statistic double, `p.value` double")


def predict_logit(df: DataFrame, fitted, out: str) -> DataFrame:
    """Linear predictor as a Column expression over the fitted coefficients
    (no model object shipped to executors), bounded to [1e-4, 1-1e-4]."""
    model, names, feats = fitted
    eta = F.lit(float(model.intercept))
    for i, (_, e) in enumerate(feats):
        eta = eta + F.lit(float(model.coefficients[i])) * e
    return df.withColumn(out, bound_probability(1 / (1 + F.exp(-eta))))


def ipcw_predictions(risk: DataFrame, den, num, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Bounded probabilities and the stabilized transition weight."""
    d = predict_logit(risk, den, "p_observed_denominator")
    d = predict_logit(d, num, "p_observed_numerator")
    return d.select(spec.id, spec.wave, "p_observed_denominator", "p_observed_numerator",
                    (F.col("p_observed_numerator") / F.col("p_observed_denominator")).alias("stabilized_transition_weight"))


def weight_summary(weighted: DataFrame, risk: DataFrame, preds: DataFrame, qs: dict, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """One row; quantiles come from ``exact_quantiles`` (``qs``)."""
    a = weighted.agg(
        F.count(F.lit(1)).alias("n_person_waves"),
        F.count_distinct(spec.id).alias("n_persons"),
        F.min("sw_cumulative").alias("sw_untruncated_min"),
        F.avg("sw_cumulative").alias("sw_untruncated_mean"),
        F.max("sw_cumulative").alias("sw_untruncated_max"),
        F.min("sw_truncated").alias("sw_truncated_min"),
        F.avg("sw_truncated").alias("sw_truncated_mean"),
        F.max("sw_truncated").alias("sw_truncated_max"),
    )
    b = risk.agg(F.count(F.lit(1)).alias("risk_set_rows_for_ipcw_models"))
    c = preds.agg(F.avg("p_observed_denominator").alias("observed_probability_mean_denominator"),
                  F.avg("p_observed_numerator").alias("observed_probability_mean_numerator"))
    out = one_row(a, b, c)
    return out.withColumns({k: F.lit(float(v)) for k, v in qs.items()})
