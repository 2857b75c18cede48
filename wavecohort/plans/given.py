"""The model-based results at given coefficients.

The fits themselves have no SQL form. What follows from their coefficients
does, so the same operators run here with coefficients, covariance
parameters and weights that are written down, over the study's own rows, and
each result has DuckDB SQL.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
from pyspark.sql import functions as F

from ..operators import design as DS
from ..operators import ipcw as W
from ..operators import lmm as M
from ..operators import logit as L
from ..spec import GROUP_LEVELS, RACE_LEVELS
from .study import Study

# The coefficients used on both sides.
THETA = (0.9, -0.01, 0.05)
THETA_2 = (1.1, 0.02, 0.08)
LOGIT_LEVELS = [("menopause_group", lv) for lv in GROUP_LEVELS[1:]] + [("race_ethnicity", lv) for lv in RACE_LEVELS[1:]]
INTERCEPT = {"denominator": 1.25, "numerator": 1.5}


def step(i: int) -> float:
    """The i-th of a row of small coefficients of either sign."""
    return ((37 * i) % 11 - 5) / 40


DENOMINATOR = {v + lv: step(i) for i, (v, lv) in enumerate(LOGIT_LEVELS)} | {
    "birth_year_c10": 0.1, "education_c12": 0.05, "lag_cognitive_score": 0.03, "lag_chronological_age": -0.01,
}
NUMERATOR = {v + lv: step(i + 3) for i, (v, lv) in enumerate(LOGIT_LEVELS)} | {"birth_year_c10": 0.08, "education_c12": 0.04}


def beta(i: int) -> float:
    """The i-th coefficient of Model 2's design."""
    return 15.0 if i == 0 else step(i)


def spread(i: int) -> tuple[float, float]:
    """The covariance of the coefficients is diag(a) + b b'."""
    return 0.01 + 0.002 * (i % 5), 0.01 * ((i * 3) % 7 - 3)


class AtGivenCoefficients(Study):
    """A study's rows with given models in the place of fitted ones."""

    def __init__(self, base: Study):
        super().__init__(base.spark, base._raw_panel, base.spec)
        self.base = base

    ipcw_panel = property(lambda s: s.base.ipcw_panel)
    ipcw_risk_set = property(lambda s: s.base.ipcw_risk_set)
    analysis = property(lambda s: s.base.analysis)
    model2_rows = property(lambda s: s.base.model2_rows)
    model2_design = property(lambda s: DS.expand(DS.MODEL_TERMS["Model 2"]))
    covariate_distribution = property(lambda s: s.base.covariate_distribution)

    @cached_property
    def ipcw_models(self):
        return W.given_logit(INTERCEPT["denominator"], DENOMINATOR), W.given_logit(INTERCEPT["numerator"], NUMERATOR)

    @cached_property
    def logit_sums(self):
        """Score, information and deviance of both observation models."""
        models = {}
        for name, (model, names, feats) in zip(("denominator", "numerator"), self.ipcw_models):
            columns = [F.lit(1.0), *[e for _, e in feats]]
            models[name] = ([L.INTERCEPT, *names], columns, [model.intercept, *model.coefficients])
        return L.sums_table(self.ipcw_risk_set, "observed_t", models)

    def fit(self, model: str = "Model 2"):
        design = self.model2_design
        a, b = (np.array(x) for x in zip(*[spread(i) for i in range(design.p)]))
        return M.FittedMixedModel("given", design.names, np.array([beta(i) for i in range(design.p)]), np.diag(a) + np.outer(b, b),
                                  np.array(THETA), 1.0, 0.0, 0, 0, np.full(design.p, np.inf), 0)

    # ---- Model 0 at given covariance parameters ------------------------------------
    @cached_property
    def growth_cases(self):
        """Model 0 at two given thetas, and weighted at the first one: name ->
        (moments, design, theta)."""
        design = DS.expand(DS.MODEL_TERMS["Model 0"])
        plain = M.person_moments(self.analysis, spec=self.spec)
        weight = 0.5 + F.pmod(F.col(self.spec.id) + F.col(self.spec.wave), F.lit(5)) / 4.0
        weighted = M.person_moments(self.analysis.withColumn("w", weight), weight="w", spec=self.spec)
        return {"plain": (plain, design, THETA), "second": (plain, design, THETA_2), "weighted": (weighted, design, THETA)}

    @cached_property
    def growth(self):
        return [M.at_theta(*given, name, "w" if name == "weighted" else None) for name, given in self.growth_cases.items()]

    def model_round_trip(self):
        """The first of these, saved and loaded, as its fixed effects."""
        path = self._folder("model")
        M.save_model(self.spark, self.growth[0], path)
        return M.fixed_effects(self.spark, M.load_model(self.spark, path)).drop("converged")

    def logit_round_trip(self):
        """The predictions of both models, saved and loaded."""
        loaded = []
        for model, names, feats in self.ipcw_models:
            path = self._folder("logit")
            known = L.LogitModel(model.intercept, model.coefficients, np.eye(1 + len(names)))
            W.save_logit(self.spark, (known, names, feats), "given", path)
            loaded.append(W.load_logit(self.spark, path))
        return W.ipcw_predictions(self.ipcw_risk_set, *loaded, self.spec)

    def _growth_table(self, fn):
        out = None
        for fit in self.growth:
            d = fn(self.spark, fit)
            out = d if out is None else out.unionByName(d)
        return out

    @cached_property
    def growth_fixed(self):
        return self._growth_table(M.fixed_effects).drop("converged")

    @cached_property
    def growth_gradient(self):
        """The deviance's derivatives in the covariance parameters."""
        return M.gradient_table(self.spark, {name: M.derivatives_at(*given) for name, given in self.growth_cases.items()})

    @cached_property
    def growth_varcomp(self):
        return self._growth_table(M.variance_components)

    @cached_property
    def growth_fit(self):
        return self._growth_table(M.fit_stats)

    @cached_property
    def growth_icc(self):
        return self._growth_table(lambda spark, fit: M.icc_by_age(spark, fit, (-10, 0, 15)))

    @cached_property
    def growth_compare(self):
        return M.compare_models(self.growth_fit.where("model <> 'weighted'").drop("reml", "weights")).orderBy("aic")

    # ---- coefficient tables over the mean of each design column ----------------------
    @cached_property
    def term_means(self):
        """A table shaped like the fixed effects, with each design column's
        mean over two models' rows in the place of the estimate."""
        natural = self.model2_rows.where(F.col("menopause_group").isin(list(self.spec.natural_groups)))
        out = None
        for label, rows, model in (("all", self.model2_rows, "Model 3"), ("natural", natural, "Model 3")):
            long = DS.design_rows(rows, DS.expand(DS.MODEL_TERMS[model]))
            mean, sd = F.avg("value"), F.stddev_samp("value")
            d = long.groupBy("term").agg(
                mean.alias("estimate"), sd.alias("std_error"), F.count("*").cast("double").alias("df"),
                (mean - sd).alias("conf_low"), (mean + sd).alias("conf_high"),
                F.max("value").alias("statistic"), F.avg((F.col("value") == 0).cast("double")).alias("p_value"),
            )
            d = d.select(F.lit(label).alias("model"), "*")
            out = d if out is None else out.unionByName(d)
        return out

    @cached_property
    def slopes(self):
        return M.slope_differences(self.term_means)

    @cached_property
    def three_way(self):
        return M.three_way_terms(self.term_means)

    @cached_property
    def sensitivity_long(self):
        return self.sensitivity_table(self.term_means)

    @cached_property
    def sensitivity_wide(self):
        return self.sensitivity_pivot(self.sensitivity_long, ["all", "natural"])
