"""The reference analysis assembled from the operators.

``Study`` holds lazily built DataFrames: nothing runs until a result is
collected or written, and each intermediate is built once per Study.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cohort as C
from ..operators import describe as D
from ..operators import ipcw as W
from ..operators import retention as R
from ..operators import integrity as I
from ..operators import design as DS
from ..operators import lmm as M
from ..operators.logit import certificate, fit_logits
from ..functions.quantile import order_statistics, quantiles_by_group
from ..session import checkpoint_dir, configure, keep, materialize, stage
from ..sources import panel as P
from ..sources.fixture import load_panel
from ..spec import (
    CATEGORICAL_COVARIATES,
    CONTINUOUS_COVARIATES,
    DEFAULT_SPEC,
    EDUCATION_LEVELS,
    RACE_LEVELS,
    STATUS_LEVELS,
    PanelSpec,
)

DECLARED_LEVELS = {
    "race_ethnicity": RACE_LEVELS,
    "education_category": EDUCATION_LEVELS,
    "baseline_cognitive_status": STATUS_LEVELS,
}


class Study:
    def __init__(self, spark: SparkSession, panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC):
        self.spark = configure(spark)
        self._raw_panel = panel
        self.spec = spec

    @classmethod
    def from_orders(cls, spark: SparkSession, sf_dir: str, spec: PanelSpec = DEFAULT_SPEC) -> "Study":
        return cls(spark, load_panel(configure(spark), sf_dir, spec), spec)

    def export(self, folder: str, names=None, fmt: str = "parquet") -> list[str]:
        """IO6: write result tables (all registered ones by default), one
        folder per result, as the analysis' output set."""
        from ..sources.panel import write_table
        from .registry import BUILDERS

        written = []
        for name in names or list(BUILDERS):
            write_table(BUILDERS[name](self), f"{folder.rstrip('/')}/{name}", fmt=fmt)
            written.append(name)
        return written

    @cached_property
    def panel(self):
        return stage(self._raw_panel)

    # ---- phase 1 ----------------------------------------------------------
    @cached_property
    def first_assessment(self):
        return I.first_assessment(self.panel, self.spec)

    @cached_property
    def exposure_age(self):
        return I.exposure_age(self.panel, self.spec)

    @cached_property
    def temporal_order(self):
        return I.temporal_order(self.panel, self.spec)

    @cached_property
    def temporal_order_summary(self):
        return I.temporal_order_summary(self.temporal_order)

    @cached_property
    def invariant_diag(self):
        return I.invariant_diag(self.panel, self.spec)

    @cached_property
    def invariant_summary(self):
        return I.invariant_summary(self.invariant_diag).orderBy(F.desc("persons_inconsistent"), "variable")

    @cached_property
    def invariant_cases(self):
        return I.invariant_cases(self.invariant_diag).orderBy("variable", self.spec.id)

    @cached_property
    def invariant_modes(self):
        return I.invariant_modes(self.panel, self.spec)

    @cached_property
    def resolved(self):
        return stage(I.resolve_invariants(self.panel, self.spec))

    @cached_property
    def transitions(self):
        return I.transitions(self.resolved, self.spec)

    @cached_property
    def transition_person(self):
        return I.transition_person(self.transitions, self.spec)

    @cached_property
    def transition_summary(self):
        return I.transition_summary(self.transition_person)

    @cached_property
    def waves(self):
        return I.all_waves(self.resolved, self.spec)

    @cached_property
    def missing_panel(self):
        return I.missing_panel(self.resolved, self.spec, self.waves)

    @cached_property
    def missingness_by_wave(self):
        return I.missingness_by_wave(self.missing_panel, self.spec)

    @cached_property
    def missingness_person(self):
        return I.missingness_person(self.missing_panel, self.spec)

    @cached_property
    def missingness_summary(self):
        return I.missingness_summary(self.missingness_person)

    @cached_property
    def integrity_flags(self):
        return I.integrity_flags(self.resolved, self.temporal_order, self.transition_person, self.spec)

    @cached_property
    def integrity_cascade(self):
        return I.integrity_cascade(self.integrity_flags)

    @cached_property
    def clean(self):
        return I.clean_panel(self.resolved, self.integrity_flags, self.spec)

    # ---- phase 2 ----------------------------------------------------------
    @cached_property
    def base(self):
        return stage(C.eligibility(self.clean, self.spec))

    @cached_property
    def cohort_flags(self):
        return C.cohort_flags(self.base, self.spec)

    @cached_property
    def exposure_availability(self):
        return C.exposure_availability(self.base, self.spec)

    @cached_property
    def baseline(self):
        return C.baseline(self.base, self.spec)

    @cached_property
    def cohort_steps(self):
        return C.cohort_steps(self.cohort_flags, self.baseline, self.spec)

    @cached_property
    def exclusion_cascade(self):
        return C.exclusion_cascade(self.cohort_steps, self.base, self.spec)

    @cached_property
    def baseline_person(self):
        return C.baseline_person(self.baseline, self.cohort_steps, self.spec)

    @cached_property
    def baseline_groups(self):
        return C.baseline_groups(self.baseline_person)

    @cached_property
    def allwaves(self):
        return stage(C.analytic_panel(self.base, self.baseline_person, self.spec))

    @cached_property
    def ready(self):
        return C.model_ready(self.allwaves)

    @cached_property
    def cohort_summary(self):
        return C.cohort_summary(self.allwaves, self.ready, self.baseline_person, self.spec)

    # ---- phase 3-7 inputs -----------------------------------------------------
    @cached_property
    def analysis_all(self):
        """Analysis variables on every post-baseline row."""
        return stage(D.analysis_vars(self.allwaves, self.spec, keep_incomplete=True))

    @cached_property
    def analysis(self):
        """Model-ready rows with analysis variables."""
        return D.complete_analysis(self.analysis_all)

    @cached_property
    def model2_rows(self):
        return D.model2_data(self.analysis)

    @cached_property
    def baseline_analysis(self):
        # one row per person, read by every balance result: a stage boundary
        return stage(D.baseline_rows(self.analysis, self.spec))

    @cached_property
    def analytic_waves(self):
        return I.all_waves(self.allwaves, self.spec)

    @cached_property
    def trajectory_summary(self):
        return D.trajectory_summary(self.analysis, self.spec)

    # ---- retention ------------------------------------------------------------
    @cached_property
    def retention_panel(self):
        return R.retention_panel(self.model2_rows, self.allwaves, self.analytic_waves, self.spec)

    @cached_property
    def attrition_events(self):
        return R.attrition_events(self.retention_panel, self.spec)

    @cached_property
    def km_curve(self):
        return R.km_curve(self.attrition_events)

    @cached_property
    def retention_by_wave(self):
        return R.retention_by_wave(self.retention_panel, self.spec).orderBy("menopause_group_label", "followup_wave")

    @cached_property
    def attrition_share(self):
        return R.attrition_share(self.attrition_events)

    # ---- IPCW -------------------------------------------------------------------
    @cached_property
    def ipcw_panel(self):
        return W.ipcw_panel(self.model2_rows, self.analysis_all, self.analytic_waves, self.spec)

    @cached_property
    def ipcw_risk_set(self):
        return stage(W.ipcw_risk_set(self.ipcw_panel))

    # ---- balance ------------------------------------------------------------------
    # Two small frames, each from one scan of the baseline rows, feed Table 1,
    # the SMDs and the tests: a few dozen rows, cached (no stage of their own).
    @cached_property
    def continuous_moments(self):
        return keep(D.all_moments(self.baseline_analysis, [v for v, _ in CONTINUOUS_COVARIATES]))

    @cached_property
    def categorical_counts(self):
        return keep(D.categorical_levels(self.baseline_analysis, [v for v, _ in CATEGORICAL_COVARIATES], DECLARED_LEVELS,
                                          self.spec.group_levels))

    @cached_property
    def smd_continuous(self):
        return D.smd_continuous(self.baseline_analysis, [v for v, _ in CONTINUOUS_COVARIATES], moments=self.continuous_moments)

    @cached_property
    def smd_categorical(self):
        return D.smd_categorical(self.categorical_counts, self.spec.group_levels)

    @cached_property
    def anova_stats(self):
        return D.anova_stats(D.group_moments(self.baseline_analysis, [v for v, _ in CONTINUOUS_COVARIATES],
                                             moments=self.continuous_moments))

    @cached_property
    def chisq_stats(self):
        return D.chisq_stats(self.categorical_counts, self.spec.group_levels)

    @cached_property
    def table1_n(self):
        return D.n_row(self.baseline_analysis, self.spec.group_levels, self.spec.group_labels)

    @cached_property
    def table1_continuous(self):
        return D.continuous_table(self.baseline_analysis, CONTINUOUS_COVARIATES, self.spec.group_levels, self.spec.group_labels,
                                  moments=self.continuous_moments)

    @cached_property
    def table1_categorical(self):
        return D.categorical_table(self.baseline_analysis, CATEGORICAL_COVARIATES, DECLARED_LEVELS, self.spec.group_levels,
                                   self.spec.group_labels, counts=self.categorical_counts)

    @cached_property
    def table1(self):
        return self.table1_n.unionByName(self.table1_continuous).unionByName(self.table1_categorical)

    @cached_property
    def smd_diagnostics(self):
        d = D.smd_diagnostics(self.baseline_analysis, CONTINUOUS_COVARIATES, CATEGORICAL_COVARIATES, DECLARED_LEVELS,
                              self.spec.group_levels, moments=self.continuous_moments, counts=self.categorical_counts)
        return d.orderBy(F.col("max_pairwise_smd").desc_nulls_last(), "variable", F.col("level_pairwise_smd").desc_nulls_last())

    @cached_property
    def model_samples(self):
        complete = F.lit(True)
        for c in D.MODEL2_COMPLETE:
            kept = F.col(c).isNotNull()
            if dict(self.analysis.dtypes)[c] in ("double", "float"):
                kept = kept & ~F.isnan(c)
            complete = complete & kept
        natural = F.col("menopause_group").isin(list(self.spec.natural_groups))
        return D.sample_rows(self.analysis, {
            "Model 0 and Model 1": F.lit(True), "Model 2": complete,
            "Model 6": complete & (F.col("baseline_normal") == 1), "Model 7": complete & natural,
        }, self.spec)

    # ---- mixed models -------------------------------------------------------------
    def model_rows(self, model: str):
        from pyspark.sql import functions as F

        if model in ("Model 0", "Model 1"):
            return self.analysis
        if model == "Model 4":
            return self.weighted_rows
        if model == "Model 6":
            return self.model2_rows.where(F.col("baseline_normal") == 1)
        if model == "Model 7":
            return self.model2_rows.where(F.col("menopause_group").isin(list(self.spec.natural_groups)))
        return self.model2_rows

    # models that are fitted from the same rows, or from some of their persons
    SAMPLES = {"Model 0": ("Model 0", "Model 1"), "Model 2": ("Model 2", "Model 3", "Model 5", "Model 6", "Model 7"),
               "Model 4": ("Model 4",)}

    def moments(self, model: str):
        """Per-person moments, checkpointed: every optimizer pass reads them.

        Three frames serve all models: Models 3 and 5 use Model 2's rows, and
        Models 6 and 7 some of its persons."""
        from pyspark.sql import functions as F

        mom = self._sample_moments(next(k for k, users in self.SAMPLES.items() if model in users))
        if model == "Model 6":
            return mom.where(F.col("baseline_normal") == 1)
        if model == "Model 7":
            return mom.where(F.col("menopause_group").isin(list(self.spec.natural_groups)))
        return mom

    def _sample_moments(self, key: str):
        cache = self.__dict__.setdefault("_moments", {})
        if key not in cache:
            w = "sw_truncated" if key == "Model 4" else None
            mom = M.person_moments(self.model_rows(key), weight=w, spec=self.spec)
            # evaluation passes are compute-bound: spread persons over all
            # task slots (round-robin, so no person group can skew a task)
            # checkpoint (lineage cut, survives executor loss) and keep in
            # executor memory: every optimizer pass rescans these moments
            cache[key] = keep(materialize(mom.repartition(self.spark.sparkContext.defaultParallelism)))
        return cache[key]

    def fit(self, model: str):
        cache = self.__dict__.setdefault("_fits", {})
        if model not in cache:
            design = M.prepare_design(self.moments(model), DS.MODEL_TERMS[model], DS.MODEL_LEVELS.get(model))
            warm = {"Model 1": "Model 0"}.get(model, "Model 2" if model not in ("Model 0", "Model 2") else None)
            start = self.fit(warm).theta if warm else None
            cache[model] = M.fit_lmm(self.moments(model), design, DS.MODEL_NAMES[model],
                                     weights="sw_truncated" if model == "Model 4" else None, start=start)
            self._release(model, cache)
        return cache[model]

    def _release(self, model: str, fits: dict):
        """Drop a moment frame from executor memory once all its models are
        fitted; its checkpoint stays."""
        key, users = next((k, u) for k, u in self.SAMPLES.items() if model in u)
        if all(m in fits for m in users):
            self._moments[key].unpersist()

    def fit_all(self, models, threads: int = 4):
        """Fit several models: warm-start anchors and every model's moments
        first (stage boundaries, serial), then the optimizers concurrently
        from driver threads; each pass is a short, latency-bound Spark job,
        so concurrent fits overlap on the cluster."""
        from concurrent.futures import ThreadPoolExecutor

        def run(ms):
            ms = [m for m in ms if m not in self.__dict__.get("_fits", {})]
            for m in ms:
                self.moments(m)  # stage boundaries stay serial
            if len(ms) > 1:
                with ThreadPoolExecutor(min(threads, len(ms))) as pool:
                    list(pool.map(self.fit, ms))
            elif ms:
                self.fit(ms[0])

        todo = list(dict.fromkeys(models))
        # warm-start anchors first (Model 0 for Model 1, Model 2 for 3-7), together
        anchors = []
        if any(m in ("Model 0", "Model 1") for m in todo):
            anchors.append("Model 0")
        if any(m not in ("Model 0", "Model 1") for m in todo):
            anchors.append("Model 2")
        run(anchors)
        run(todo)
        return [self.fit(m) for m in todo]

    def _stack(self, fn, models, phase5: bool = False):
        """One table over several fits; ``phase5`` uses the sensitivity
        phase's label for Model 2."""
        self.fit_all(models)
        out = None
        for m in models:
            label = DS.PHASE5_NAMES.get(m) if phase5 else None
            d = fn(self.spark, self.fit(m), label)
            out = d if out is None else out.unionByName(d)
        return out

    @cached_property
    def lmm_certificate(self):
        """Whether every model's optimum is certified."""
        return M.certificate(self.spark, self.fit_all(DS.MODEL_NAMES))

    def fixed_effects(self, models=("Model 0", "Model 1", "Model 2"), phase5: bool = False):
        return self._stack(M.fixed_effects, models, phase5)

    def variance_components(self, models=("Model 0", "Model 1", "Model 2"), phase5: bool = False):
        return self._stack(M.variance_components, models, phase5)

    def fit_stats(self, models=("Model 0", "Model 1", "Model 2"), phase5: bool = False):
        return self._stack(M.fit_stats, models, phase5)

    @cached_property
    def icc(self):
        from ..spec import ICC_AGES_C65

        return M.icc_by_age(self.spark, self.fit("Model 0"), ICC_AGES_C65)

    @cached_property
    def slope_differences(self):
        return M.slope_differences(self.fixed_effects())

    @cached_property
    def three_way(self):
        return M.three_way_terms(self.fixed_effects(("Model 3",)))

    @cached_property
    def model_compare(self):
        from pyspark.sql import functions as F

        return M.compare_models(self.fit_stats(("Model 2", "Model 5"), phase5=True).drop("reml", "weights")).orderBy("aic")

    @cached_property
    def lmm_moments(self):
        return M.person_moments(self.model2_rows, spec=self.spec)

    @cached_property
    def design_matrix(self):
        rows = self.model2_rows
        return DS.design_rows(rows, M.prepare_design(rows, DS.MODEL_TERMS["Model 2"]))

    # ---- IPCW weights --------------------------------------------------------------
    @cached_property
    def ipcw_models(self):
        """Denominator and numerator model, fitted in the same passes."""
        terms = {"denominator": W.DENOMINATOR_TERMS, "numerator": W.NUMERATOR_TERMS}
        return tuple(fit_logits(self.ipcw_risk_set, terms, "observed_t").values())

    @cached_property
    def ipcw_certificate(self):
        return certificate(self.spark, dict(zip(("denominator", "numerator"), self.ipcw_models)))

    @cached_property
    def ipcw_coefficients(self):
        den, num = self.ipcw_models
        return W.logit_coefficients(self.spark, den, "Denominator: baseline covariates + lagged cognition + lagged age").unionByName(
            W.logit_coefficients(self.spark, num, "Numerator: baseline covariates only"))

    @cached_property
    def ipcw_predictions(self):
        den, num = self.ipcw_models
        return W.ipcw_predictions(self.ipcw_risk_set, den, num, self.spec)

    @cached_property
    def ipcw_weights(self):
        return W.cumulative_weights(self.ipcw_panel, self.ipcw_predictions, self.spec)

    @cached_property
    def untruncated_rows(self):
        return stage(W.attach_weights(self.model2_rows, self.ipcw_weights, self.spec))

    @cached_property
    def untruncated_statistics(self):
        """The order statistics around the 1st, 50th and 99th percentile of the
        untruncated weights, computed once for the truncation bounds and the
        summary."""
        return order_statistics(self.untruncated_rows, "sw_cumulative", [0.01, 0.5, 0.99])

    @cached_property
    def weight_bounds(self):
        (a, b, v), _, (c, d, w) = self.untruncated_statistics
        return a + v * (b - a), c + w * (d - c)

    @cached_property
    def weighted_rows(self):
        lo, hi = self.weight_bounds
        return W.truncate_weights(self.untruncated_rows, lo, hi)

    @cached_property
    def weight_summary(self):
        lo, hi = self.weight_bounds
        a, b, w = self.untruncated_statistics[1]
        # truncation keeps the order: the truncated median lies between the same order statistics, truncated
        ta, tb = (min(max(x, lo), hi) for x in (a, b))
        qs = {"sw_untruncated_p01": lo, "sw_untruncated_median": a + w * (b - a), "sw_untruncated_p99": hi,
              "sw_truncated_median": ta + w * (tb - ta)}
        return W.weight_summary(self.weighted_rows, self.ipcw_risk_set, self.ipcw_predictions, qs, self.spec)

    # ---- predictions ----------------------------------------------------------------
    @cached_property
    def covariate_distribution(self):
        from ..operators import predict as V

        return V.covariate_distribution(self.model2_rows, self.spec)

    @cached_property
    def model2_design(self):
        return M.prepare_design(self.model2_rows, DS.MODEL_TERMS["Model 2"])

    @cached_property
    def covariate_means(self):
        from ..operators import predict as V

        return V.covariate_means(self.covariate_distribution, self.model2_design)

    @cached_property
    def fitted_design(self):
        """Model 2's design as fitted, without rank-deficient columns."""
        kept = set(self.fit("Model 2").terms)
        return DS.Design([c for c in self.model2_design.columns if c.name in kept], list(self.fit("Model 2").dropped))

    def marginal_means_at(self, ages):
        from ..operators import predict as V

        return V.marginal_means(self.spark, self.fit("Model 2"), self.fitted_design, self.covariate_means, ages,
                                self.spec.group_levels, self.spec.group_labels)

    @cached_property
    def marginal_means(self):
        from ..spec import TABLE8_AGES

        return self.marginal_means_at(TABLE8_AGES)

    @cached_property
    def average_design_joint(self):
        """Averages of a design with products of person covariates."""
        from ..operators import predict as V
        from ..spec import TABLE8_AGES

        design = DS.expand(DS.JOINT_TERMS)
        means = V.covariate_means(self.covariate_distribution, design)
        return V.average_design_table(self.spark, design, means, TABLE8_AGES, self.spec.group_levels)

    # ---- round trips ------------------------------------------------------------------
    def _folder(self, name: str) -> str:
        return f"{checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"

    def stage_round_trip(self):
        """The panel through a stage: written, committed, checked, read back."""
        path = self._folder("stage")
        P.save_stage(self.panel, path, self.spec)
        return P.load_stage(self.spark, path, self.spec, verify=True)

    def sink_round_trip(self):
        """The panel through the CSV sink and the CSV panel reader."""
        path = self._folder("sink")
        P.write_table(self.panel, path, fmt="csv")
        return P.read_panel(self.spark, path, self.spec, fmt="csv").select(*self.panel.columns)

    @cached_property
    def average_design(self):
        from ..operators import predict as V
        from ..spec import TABLE8_AGES

        return V.average_design_table(self.spark, self.model2_design, self.covariate_means, TABLE8_AGES, self.spec.group_levels)

    @cached_property
    def clinical_contrasts(self):
        from ..operators import predict as V
        from ..spec import CONTRAST_GROUPS, TABLE8_AGES

        return V.clinical_contrasts(self.spark, self.fit("Model 2"), self.fitted_design, self.covariate_means, TABLE8_AGES,
                                    CONTRAST_GROUPS, self.spec.group_levels[0], self.spec.group_labels)

    @cached_property
    def trajectories(self):
        from ..spec import TRAJECTORY_AGES

        means = self.marginal_means_at(TRAJECTORY_AGES).drop("L", "predicted_score_ci")
        return means.orderBy("menopause_group", "chronological_age")

    @cached_property
    def trajectory_range(self):
        from ..operators import predict as V

        return V.trajectory_range(self.trajectories)

    # ---- sensitivity (M11) -------------------------------------------------------------
    @cached_property
    def sensitivity_long(self):
        fe = self.fixed_effects(("Model 2", "Model 4", "Model 6", "Model 7"), phase5=True)
        return self.sensitivity_table(fe)

    def sensitivity_table(self, fixed_effects):
        """M11 in long form, from any table of fixed effects."""
        from pyspark.sql import functions as F

        from ..functions.exprs import recode
        from ..operators.describe import format_p

        d = M.slope_differences(fixed_effects, exclude_other=True)
        return d.select(
            "model",
            recode("contrast", self.spec.group_labels).alias("contrast"),
            "estimate", "std_error", "conf_low", "conf_high", "p_value",
            F.format_string("%.4f [%.4f, %.4f]", "estimate", "conf_low", "conf_high").alias("estimate_ci"),
            format_p("p_value").alias("p_value_formatted"),
            "term",
        ).orderBy("contrast", "model")

    @cached_property
    def sensitivity_wide(self):
        names = [DS.PHASE5_NAMES.get(m, DS.MODEL_NAMES[m]) for m in ("Model 2", "Model 4", "Model 6", "Model 7")]
        return self.sensitivity_pivot(self.sensitivity_long, names)

    @staticmethod
    def sensitivity_pivot(long, names):
        """M11 in wide form: one column per model."""
        from pyspark.sql import functions as F

        d = long.withColumn("result", F.concat("estimate_ci", F.lit("; p="), "p_value_formatted"))
        return d.groupBy("contrast").pivot("model", names).agg(F.first("result")).orderBy("contrast")

    @cached_property
    def loess_curve(self):
        return D.loess_curve(self.analysis)

    @cached_property
    def loess_surface(self):
        return D.loess_curve(self.analysis, surface="interpolate")

    @cached_property
    def loess_band(self):
        return D.loess_band(self.analysis)

    @cached_property
    def score_quantiles(self):
        """Median and 1st and 99th percentile of the score by group and wave."""
        probs = {"p01": 0.01, "median": 0.5, "p99": 0.99}
        rows = self.analysis.where(F.col("menopause_group").isNotNull())
        return quantiles_by_group(rows, ["menopause_group", self.spec.wave], "cognitive_score", probs)

    # ---- validation and small reports ---------------------------------------------
    @cached_property
    def input_validation(self):
        from ..sources.panel import validate_counts

        return validate_counts(
            self.spec.id,
            baseline_person=self.baseline_person,
            baseline_rows=self.baseline_analysis,
            analytic_allwaves=self.analysis_all,
            modelready=self.analysis,
            model2=self.model2_rows,
            standardization=self.covariate_distribution,
        )

    @cached_property
    def surgical_absorbing(self):
        from pyspark.sql import functions as F

        d = self.base.select(self.spec.id, self.spec.wave,
                             F.coalesce(F.col(self.spec.exposure) == "6.Surgical", F.lit(False)).alias("surgical_now"))
        return I.absorbing_state(d, "surgical_now", "surgical_absorbing", self.spec)

    @cached_property
    def smd_top(self):
        from pyspark.sql import functions as F

        return self.smd_diagnostics.orderBy(
            F.col("max_pairwise_smd").desc_nulls_last(), F.col("variable").asc_nulls_last(),
            F.col("level_pairwise_smd").desc_nulls_last(), F.col("level").asc_nulls_last(),
        ).limit(12)

    # ---- the reference's per-phase validation tables -------------------------------
    @cached_property
    def validation_phase3(self):
        from pyspark.sql import functions as F

        from ..functions.exprs import one_row

        return one_row(
            self.baseline_person.agg(F.count(F.lit(1)).alias("phase2_baseline_persons")),
            self.baseline_analysis.agg(F.count(F.lit(1)).alias("phase3_baseline_rows")),
            self.analysis.agg(F.count(F.lit(1)).alias("phase4_modelready_person_waves"),
                              F.count_distinct(self.spec.id).alias("phase4_modelready_persons")),
        )

    @cached_property
    def validation_phase5(self):
        from pyspark.sql import functions as F

        from ..functions.exprs import one_row

        return one_row(
            self.analysis_all.agg(F.count(F.lit(1)).alias("phase2_allwaves_rows")),
            self.analysis.agg(F.count(F.lit(1)).alias("phase2_modelready_rows")),
            self.model2_rows.agg(F.count(F.lit(1)).alias("model2_complete_case_rows"),
                                 F.count_distinct(self.spec.id).alias("model2_complete_case_persons")),
        )

    @cached_property
    def validation_phase7(self):
        from pyspark.sql import functions as F

        from ..functions.exprs import one_row

        return one_row(
            self.model2_rows.agg(F.count(F.lit(1)).alias("model2_person_waves"),
                                 F.count_distinct(self.spec.id).alias("model2_persons"),
                                 F.min("chronological_age").alias("min_age_model2_data"),
                                 F.max("chronological_age").alias("max_age_model2_data")),
            self.covariate_distribution.agg(F.count(F.lit(1)).alias("person_rows_for_standardization")),
        )
