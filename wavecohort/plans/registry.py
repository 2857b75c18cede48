"""Registered results: name -> Spark callable and DuckDB check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import column_types as CT
from ..sources import panel as P
from ..sources import planted as PL
from . import oracle as O
from . import source_oracle as _SO  # noqa: F401  (registers its CTEs)
from .study import Study

QUERIES: dict = {}
ORACLE: dict = {}
BUILDERS: dict = {}
_STUDIES: dict = {}


def study_for(spark, sf_dir: str) -> Study:
    """One Study per (Spark application, data folder): results requested
    one by one share its checkpointed stages instead of rebuilding them.
    A new session (new application id) gets a fresh Study."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STUDIES:
        _STUDIES[key] = Study.from_orders(spark, sf_dir)
    return _STUDIES[key]


def _round_sql(sql: str, doubles: tuple[str, ...]) -> str:
    if not doubles:
        return sql
    rep = ", ".join(f'round("{c}", 6) as "{c}"' for c in doubles)
    return f"select * replace ({rep}) from (\n{sql}\n)"


def register(name: str, build, cte: str | None = None, doubles: tuple[str, ...] = (), select: str | None = None):
    """``build(study) -> DataFrame``; ``cte`` names the oracle CTE (None =
    rows-only check)."""
    BUILDERS[name] = build
    QUERIES[name] = lambda spark, sf_dir: build(study_for(spark, sf_dir))
    if cte is not None:
        ORACLE[name] = _round_sql(O.sql_for(cte, select), doubles)


# ---- sources ---------------------------------------------------------------
register("panel_scan", lambda s: s.panel, "panel", ("agey_e", "cogtot27_imp", "C253_age"))
register("raw_inventory", lambda s: P.raw_inventory(s.panel, s.spec), "panel", select="""
select 'panel' as dataset, cast(count(*) as bigint) as n_rows, cast(count(distinct hhidpn) as bigint) as n_persons,
  min(wave) as min_wave, max(wave) as max_wave, min(year) as min_year, max(year) as max_year,
  'cogtot27_imp' as cognition_variable, 'agey_e' as age_variable, 'C253_age' as menopause_age_variable from panel""")

register("parse_diagnostics", lambda s: PL.planted_diagnostics(s.panel), "planted_faults")
register("csv_records", lambda s: PL.planted_records(s.panel), "planted_panel", ("agey_e", "cogtot27_imp", "C253_age"))
register("stage_round_trip", lambda s: s.stage_round_trip(), "panel", ("agey_e", "cogtot27_imp", "C253_age"))
register("sink_round_trip", lambda s: s.sink_round_trip(), "panel", ("agey_e", "cogtot27_imp", "C253_age"))
register("type_inference", lambda s: CT.infer_types(PL.mixed_text(s.panel)), "column_types")

# ---- phase 1 ---------------------------------------------------------------
register("first_assessment", lambda s: s.first_assessment, "first_assessment", ("first_cog_age", "first_cog_score"))
register("exposure_age", lambda s: s.exposure_age, "exposure_age",
         ("menopause_age_resolved", "menopause_age_min", "menopause_age_max"))
register("temporal_order", lambda s: s.temporal_order, "temporal_order",
         ("first_cog_age", "first_cog_score", "menopause_age_resolved", "menopause_age_min", "menopause_age_max"))
register("temporal_order_summary", lambda s: s.temporal_order_summary, "temporal_order_summary")
register("invariant_diag", lambda s: s.invariant_diag, "invariant_diag")
register("invariant_summary", lambda s: s.invariant_summary, "invariant_summary", ("pct_inconsistent",))
register("mode_resolve", lambda s: s.invariant_modes, "invariant_modes")
register("transitions", lambda s: s.transitions, "transitions")
register("status_sequence", lambda s: s.transition_person, "transition_person")
register("transition_summary", lambda s: s.transition_summary, "transition_summary")
register("missing_panel", lambda s: s.missing_panel, "missing_panel", ("age", "cognition"))
register("score_by_wave", lambda s: s.missing_panel.where("row_present").select(s.spec.id, s.spec.wave, "year", "age", "cognition"),
         "missing_panel", ("age", "cognition"),
         select="select hhidpn, wave, year, age, cognition from missing_panel where row_present")
register("missingness_by_wave", lambda s: s.missingness_by_wave, "missingness_by_wave", ("pct_missing_cognition_or_row",))
register("missingness_person", lambda s: s.missingness_person, "missingness_person")
register("missingness_summary", lambda s: s.missingness_summary, "missingness_summary", ("pct_persons",))
register("integrity_flags", lambda s: s.integrity_flags, "integrity_flags", ("first_cog_age", "menopause_age_resolved"))
register("integrity_cascade", lambda s: s.integrity_cascade, "integrity_cascade")
register("clean_panel", lambda s: s.clean, "clean", ("agey_e", "cogtot27_imp", "C253_age"))

# ---- phase 2 ---------------------------------------------------------------
register("eligibility", lambda s: s.base, "base", ("agey_e", "cogtot27_imp", "C253_age"))
register("cohort_flags", lambda s: s.cohort_flags, "cohort_flags")
register("exposure_availability", lambda s: s.exposure_availability, "exposure_availability")
register("exposure_summary", lambda s: s.exposure_availability.groupBy("exposure_problem_class").agg(F.count(F.lit(1)).alias("n_persons")),
         "exposure_availability",
         select="select exposure_problem_class, cast(count(*) as bigint) as n_persons from exposure_availability group by 1")
register("baseline", lambda s: s.baseline, "baseline", ("baseline_age", "baseline_cognition", "baseline_exposure_age"))
register("exclusion_cascade", lambda s: s.exclusion_cascade, "exclusion_cascade")
register("baseline_groups", lambda s: s.baseline_groups, "baseline_groups")
register("analytic_panel", lambda s: s.allwaves, "allwaves",
         ("agey_e", "cogtot27_imp", "C253_age", "baseline_age", "baseline_cognition", "baseline_exposure_age", "age_centered_65"))
register("cohort_summary", lambda s: s.cohort_summary, "cohort_summary",
         ("mean_valid_cognitive_assessments_per_person", "median_valid_cognitive_assessments_per_person"))

# ---- analysis variables, retention, IPCW panel ------------------------------------
from ..functions.dist import chisq_pvalue as _chisq_pvalue  # noqa: E402
from ..functions.dist import f_pvalue as _f_pvalue  # noqa: E402
from ..operators import describe as _D  # noqa: E402

_AV = ("hhidpn", "wave") + _D.ANALYSIS_COLUMNS
register("analysis_vars", lambda s: s.analysis.select(*_AV), "analysis",
         ("cognitive_score", "chronological_age", "age_c65", "age_c65_sq", "education_years", "education_c12", "birth_year", "birth_year_c10"),
         select="select " + ", ".join(_AV) + " from analysis")
register("baseline_rows", lambda s: s.baseline_analysis.select(*_AV, "baseline_wave"), "baseline_analysis",
         ("cognitive_score", "chronological_age", "age_c65", "age_c65_sq", "education_years", "education_c12", "birth_year", "birth_year_c10"),
         select="select " + ", ".join(_AV) + ", baseline_wave from baseline_analysis")
register("trajectory_summary", lambda s: s.trajectory_summary, "trajectory_summary", ("min_age", "max_age"))
register("retention_panel", lambda s: s.retention_panel, "retention_panel")
register("person_wave_grid", lambda s: s.retention_panel.select("hhidpn", "wave"), "retention_panel",
         select="select hhidpn, wave from retention_panel")
register("attrition_events", lambda s: s.attrition_events, "attrition_events", ("first_missing_followup", "time_to_attrition_or_censor"))
register("km_curve", lambda s: s.km_curve, "km_curve",
         ("followup_wave", "retention_probability", "std_error", "conf_low", "conf_high"))
register("retention_by_wave", lambda s: s.retention_by_wave, "retention_by_wave", ("simple_retention_proportion",))
register("attrition_share", lambda s: s.attrition_share, "attrition_share", ("pct",))
register("ipcw_panel", lambda s: s.ipcw_panel, "ipcw_panel",
         ("birth_year_c10", "education_c12", "cognitive_score", "chronological_age", "lag_cognitive_score", "lag_chronological_age"))
register("ipcw_risk_set", lambda s: s.ipcw_risk_set, "ipcw_risk_set",
         ("birth_year_c10", "education_c12", "cognitive_score", "chronological_age", "lag_cognitive_score", "lag_chronological_age"))

# ---- balance -----------------------------------------------------------------------
register("smd_continuous", lambda s: s.smd_continuous, "smd_continuous", ("max_pairwise_smd",))
register("smd_categorical", lambda s: s.smd_categorical, "smd_categorical", ("level_pairwise_smd", "max_pairwise_smd"))
register("anova_stats", lambda s: s.anova_stats, "anova_stats", ("f_statistic",))
register("chisq_stats", lambda s: s.chisq_stats, "chisq_stats", ("chi_square",))
register("chisq_nonempty", lambda s: _D.chisq_stats(s.categorical_counts, s.spec.group_levels, emulate_empty_levels=False),
         "chisq_nonempty", ("chi_square",))
register("anova_p", lambda s: s.anova_stats.select("variable", _f_pvalue("f_statistic", F.col("df1").cast("double"), F.col("df2").cast("double")).alias("p")),
         "anova_p", ("p",))
register("chisq_p", lambda s: s.chisq_stats.select(
    "variable", F.when(F.col("chi_square").isNotNull(), _chisq_pvalue("chi_square", F.col("df").cast("double"))).alias("p")), "chisq_p", ("p",))
register("table1", lambda s: s.table1, "table1")
register("smd_diagnostics", lambda s: s.smd_diagnostics, "smd_diagnostics", ("level_pairwise_smd", "max_pairwise_smd"))
register("model_samples", lambda s: s.model_samples, "model_samples")

# ---- mixed models, IPCW weights, predictions (rows-only checks + pytest numerics) ----
register("lmm_moments", lambda s: s.lmm_moments.drop("_nonconstant"), "lmm_moments",
         ("s0", "s1", "s2", "s3", "s4", "z0", "z1", "z2", "yy", "lw", "birth_year_c10", "education_c12"))
register("design_matrix", lambda s: s.design_matrix, "design_matrix", ("value",))
register("lmm_fixed", lambda s: s.fixed_effects())
register("lmm_varcomp", lambda s: s.variance_components())
register("lmm_fit", lambda s: s.fit_stats())
register("lmm_icc", lambda s: s.icc)
register("slope_diff", lambda s: s.slope_differences)
register("three_way", lambda s: s.three_way)
register("model_compare", lambda s: s.model_compare)
register("lmm_weighted", lambda s: s.fixed_effects(("Model 4",)))
register("lmm_sensitivity", lambda s: s.fixed_effects(("Model 2", "Model 3", "Model 4", "Model 5", "Model 6", "Model 7"), phase5=True))
register("sensitivity_wide", lambda s: s.sensitivity_wide)
register("ipcw_models", lambda s: s.ipcw_coefficients)
register("ipcw_weights", lambda s: s.ipcw_weights.select("hhidpn", "wave", "at_risk_for_observation", "observed_cognition",
                                                          "transition_weight_for_observed_outcome", "sw_cumulative"))
register("truncate_weights", lambda s: s.weighted_rows.select("hhidpn", "wave", "sw_cumulative", "sw_truncated"))
register("weight_summary", lambda s: s.weight_summary)
register("covariate_distribution", lambda s: s.covariate_distribution, "covdist", ("birth_year_c10", "education_c12"))
register("average_design_joint", lambda s: s.average_design_joint, "average_design_joint", ("value",))
register("average_design", lambda s: s.average_design, "average_design", ("value",))
register("marginal_means", lambda s: s.marginal_means)
register("clinical_contrasts", lambda s: s.clinical_contrasts)
register("trajectories", lambda s: s.trajectories)
register("trajectory_range", lambda s: s.trajectory_range)
register("loess_curve", lambda s: s.loess_curve, "loess_curve", ("chronological_age", "fit"))
register("loess_surface", lambda s: s.loess_surface, "loess_surface", ("chronological_age", "fit"))
register("score_quantiles", lambda s: s.score_quantiles, "score_quantiles", ("p01", "median", "p99"))
register("loess_band", lambda s: s.loess_band, "loess_band",
         ("chronological_age", "fit", "std_error", "conf_low", "conf_high", "equivalent_parameters"))
register("input_validation", lambda s: s.input_validation, "input_validation")
register("absorbing_state", lambda s: s.surgical_absorbing, "surgical_absorbing")
register("invariant_cases", lambda s: s.invariant_cases, "invariant_cases")
register("smd_top", lambda s: s.smd_top, "smd_top", ("level_pairwise_smd", "max_pairwise_smd"))
register("table1_n", lambda s: s.table1_n, "table1_n")
register("table1_continuous", lambda s: s.table1_continuous, "table1_continuous")
register("table1_categorical", lambda s: s.table1_categorical, "table1_categorical")
_P56 = ("Model 3", "Model 4", "Model 5", "Model 6", "Model 7")
register("lmm_varcomp_sensitivity", lambda s: s.variance_components(_P56, phase5=True))
register("lmm_fit_sensitivity", lambda s: s.fit_stats(("Model 2",) + _P56, phase5=True))
register("sensitivity_long", lambda s: s.sensitivity_long)
register("ipcw_predictions", lambda s: s.ipcw_predictions)
register("validation_phase3", lambda s: s.validation_phase3, "validation_phase3")
register("validation_phase5", lambda s: s.validation_phase5, "validation_phase5")
register("validation_phase7", lambda s: s.validation_phase7, "validation_phase7", ("min_age_model2_data", "max_age_model2_data"))
from ..operators import predict as _V  # noqa: E402

register("clinical_contrasts_formatted", lambda s: _V.format_contrasts(s.clinical_contrasts))
from ..operators import lmm as _M  # noqa: E402

register("lmm_fixed_formatted", lambda s: _M.format_fixed_effects(s.fixed_effects()))

# ---- model-based results at given coefficients (SQL-checked) -----------------------------
from . import given_oracle as _GO  # noqa: E402,F401  (registers its CTEs)
from .given import AtGivenCoefficients as _At  # noqa: E402

_GIVEN: dict = {}


def _given(study):
    if study not in _GIVEN:
        _GIVEN.clear()
        _GIVEN[study] = _At(study)
    return _GIVEN[study]


def _register_given(name, build, doubles=()):
    register(name, lambda s: build(_given(s)), name, doubles)


_EST = ("estimate", "std_error", "conf_low", "conf_high", "p_value")
_PRED = ("predicted_score", "std_error", "conf_low", "conf_high")
_register_given("given_predictions", lambda g: g.ipcw_predictions,
                ("p_observed_denominator", "p_observed_numerator", "stabilized_transition_weight"))
_register_given("logit_sums", lambda g: g.logit_sums, ("value",))
register("ipcw_certificate", lambda s: s.ipcw_certificate, "ipcw_certificate")
_register_given("given_weights", lambda g: g.ipcw_weights.select("hhidpn", "wave", "at_risk_for_observation", "observed_cognition",
                                                                 "transition_weight_for_observed_outcome", "sw_cumulative"),
                ("transition_weight_for_observed_outcome", "sw_cumulative"))
_register_given("given_truncated", lambda g: g.weighted_rows.select("hhidpn", "wave", "sw_cumulative", "sw_truncated"),
                ("sw_cumulative", "sw_truncated"))
_register_given("given_weight_summary", lambda g: g.weight_summary,
                ("sw_untruncated_min", "sw_untruncated_mean", "sw_untruncated_max", "sw_truncated_min", "sw_truncated_mean",
                 "sw_truncated_max", "observed_probability_mean_denominator", "observed_probability_mean_numerator",
                 "sw_untruncated_p01", "sw_untruncated_median", "sw_untruncated_p99", "sw_truncated_median"))
_register_given("given_marginal_means", lambda g: g.marginal_means.drop("L"), _PRED)
_register_given("given_contrasts", lambda g: g.clinical_contrasts,
                ("reference_predicted_score", "comparison_predicted_score", "absolute_difference", "std_error", "conf_low",
                 "conf_high", "p_value"))
_register_given("given_contrasts_formatted", lambda g: _V.format_contrasts(g.clinical_contrasts))
_register_given("given_trajectories", lambda g: g.trajectories, _PRED)
_register_given("given_trajectory_range", lambda g: g.trajectory_range, ("min_predicted", "max_predicted"))
_register_given("growth_fixed", lambda g: g.growth_fixed, _EST + ("statistic", "df"))
register("model_round_trip", lambda s: _given(s).model_round_trip(), "growth_fixed", _EST + ("statistic", "df"),
         select="select * from growth_fixed where model = 'plain'")
register("logit_round_trip", lambda s: _given(s).logit_round_trip(), "given_predictions",
         ("p_observed_denominator", "p_observed_numerator", "stabilized_transition_weight"))
_register_given("growth_gradient", lambda g: g.growth_gradient, ("gradient", "hessian"))
register("lmm_certificate", lambda s: s.lmm_certificate, "lmm_certificate")
_register_given("growth_varcomp", lambda g: g.growth_varcomp, ("variance_or_covariance", "sd_or_correlation"))
_register_given("growth_fit", lambda g: g.growth_fit, ("aic", "bic", "log_likelihood", "deviance"))
_register_given("growth_icc", lambda g: g.growth_icc, ("chronological_age", "age_c65", "between_person_variance", "residual_variance", "icc"))
_register_given("growth_compare", lambda g: g.growth_compare,
                ("aic", "bic", "log_likelihood", "deviance", "delta_aic_vs_best", "delta_bic_vs_best"))
_register_given("given_slopes", lambda g: g.slopes, _EST + ("df", "statistic"))
_register_given("given_three_way", lambda g: g.three_way, _EST + ("df", "statistic"))
_register_given("given_sensitivity_long", lambda g: g.sensitivity_long, _EST)
_register_given("given_sensitivity_wide", lambda g: g.sensitivity_wide)
_register_given("given_fixed_formatted", lambda g: _M.format_fixed_effects(g.slopes))
