"""Numeric cross-checks on sf0.01 results (test-side collects only)."""

import math

import numpy as np
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def study(spark):
    from wavecohort.plans.study import Study

    return Study.from_orders(spark, SF)


def test_glm_matches_numpy_irls(study):
    from wavecohort.operators import ipcw as W

    den, _ = study.ipcw_models
    model, names, feats = den
    data = study.ipcw_risk_set.select("observed_t", *[e.alias(n) for n, e in feats]).toPandas()
    X = np.column_stack([np.ones(len(data))] + [data[n].to_numpy(float) for n in names])
    y = data["observed_t"].to_numpy(float)
    b = np.zeros(X.shape[1])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-X @ b))
        w = mu * (1 - mu)
        z = X @ b + (y - mu) / w
        b_new = np.linalg.solve(X.T @ (w[:, None] * X), X.T @ (w * z))
        if np.max(np.abs(b_new - b)) < 1e-12:
            b = b_new
            break
        b = b_new
    mu = 1 / (1 + np.exp(-X @ b))
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ ((mu * (1 - mu))[:, None] * X))))
    coef = study.ipcw_coefficients.where("model like 'Denominator%'").collect()
    got = {r["term"]: (r["estimate"], r["std.error"]) for r in coef}
    for j, n in enumerate(["(Intercept)"] + names):
        assert abs(got[n][0] - b[j]) < 1e-6, n
        assert abs(got[n][1] - se[j]) < 1e-6, n



def test_glm_fit_releases_its_cache(spark, study):
    """The narrow IRLS input is cached only for the fit (a leak would pin the
    risk set in executor memory at scale)."""
    from wavecohort.operators import ipcw as W

    risk = study.ipcw_risk_set
    persistent = spark.sparkContext._jsc.getPersistentRDDs
    before = persistent().size()
    model, names, _ = W.fit_logit(risk, W.NUMERATOR_TERMS)
    assert persistent().size() == before
    assert len(names) == len(model.coefficients)

def test_loess_matches_direct_wls(study):
    raw = study.analysis.select("menopause_group", "chronological_age", "cognitive_score").toPandas()
    curve = study.loess_curve.toPandas()
    for g in ("6.Surgical", "4.50-55 Natural (ref)"):
        d = raw[raw.menopause_group == g]
        x, y = d.chronological_age.to_numpy(float), d.cognitive_score.to_numpy(float)
        q = int(math.floor(0.75 * len(x)))
        for _, row in curve[curve.menopause_group == g].iloc[::17].iterrows():
            x0 = row["chronological_age"]
            dist = np.abs(x - x0)
            h = np.sort(dist)[q - 1]
            w = np.where(dist < h, (1 - (dist / h) ** 3) ** 3, 0.0)
            X = np.column_stack([np.ones_like(x), x - x0, (x - x0) ** 2])
            beta = np.linalg.solve(X.T @ (w[:, None] * X), X.T @ (w * y))
            assert abs(beta[0] - row["fit"]) < 1e-8


def test_loess_band_matches_the_smoother_matrix(study):
    from wavecohort.functions import dist

    raw = study.analysis.select("menopause_group", "chronological_age", "cognitive_score").toPandas()
    curve = study.loess_band.toPandas()
    g = "6.Surgical"
    d = raw[(raw.menopause_group == g) & (raw.chronological_age >= 50) & raw.cognitive_score.between(0, 27)]
    x, y = d.chronological_age.to_numpy(float), d.cognitive_score.to_numpy(float)
    q = int(math.floor(0.75 * len(x)))

    def row(x0):
        away = np.abs(x - x0)
        h = np.sort(away)[q - 1]
        w = np.where(away < h, (1 - (away / h) ** 3) ** 3, 0.0)
        X = np.column_stack([np.ones_like(x), x - x0, (x - x0) ** 2])
        return np.linalg.solve(X.T @ (w[:, None] * X), (w[:, None] * X).T)[0]

    left = np.eye(len(x)) - np.array([row(v) for v in x])
    M = left @ left.T
    d1, d2 = np.trace(M), float((M * M).sum())
    s = math.sqrt(float(((left @ y) ** 2).sum()) / d1)
    t = dist.t_ppf(0.975, d1 * d1 / d2)
    for _, r in curve[curve.menopause_group == g].iloc[::13].iterrows():
        se = s * math.sqrt(float((row(r["chronological_age"]) ** 2).sum()))
        assert abs(r["std_error"] / se - 1) < 1e-8
        assert abs(r["conf_high"] - (r["fit"] + t * se)) < 1e-6 and abs(r["conf_low"] - (r["fit"] - t * se)) < 1e-6
    assert abs(curve[curve.menopause_group == g].equivalent_parameters.iloc[0] - (len(x) - np.trace(left))) < 1e-8


def test_table1_p_values(study):
    from wavecohort.functions import dist
    from wavecohort.operators.describe import group_moments
    from wavecohort.spec import CONTINUOUS_COVARIATES

    t1 = {(r["Characteristic"], r["Level"]): r for r in study.table1.collect()}
    stats = {r["variable"]: r for r in study.anova_stats.collect()}
    for var, label in CONTINUOUS_COVARIATES:
        s = stats[var]
        p = dist.f_sf(s["f_statistic"], s["df1"], s["df2"])
        want = "<0.001" if p < 0.001 else f"{p:.3f}"
        assert t1[(label, "Mean (SD)")]["P value"] == want
    # chi-square: statistic and df by hand from the contingency counts
    counts = study.categorical_counts.where("variable = 'education_category'").toPandas()
    groups = list(study.spec.group_levels)
    O = counts[groups].to_numpy(float)
    assert study.chisq_stats.where("variable = 'education_category'").first()["chi_square"] is None or (O.sum(axis=1) > 0).all()
    O = O[O.sum(axis=1) > 0][:, O.sum(axis=0) > 0]
    E = O.sum(axis=1, keepdims=True) * O.sum(axis=0, keepdims=True) / O.sum()
    chi = float(((O - E) ** 2 / E).sum())
    from wavecohort.operators.describe import chisq_stats

    got = chisq_stats(study.categorical_counts, groups, emulate_empty_levels=False).where("variable = 'education_category'").first()
    assert abs(got["chi_square"] - chi) < 1e-9 and got["df"] == (O.shape[0] - 1) * (O.shape[1] - 1)


def test_weights_are_one_at_baseline(study):
    rows = study.ipcw_weights.where("wave = baseline_wave").select("sw_cumulative").collect()
    assert rows and all(abs(r[0] - 1.0) < 1e-15 for r in rows)
    assert study.weighted_rows.where("sw_truncated is null").count() == 0


def test_marginal_mean_is_average_of_person_predictions(study):
    from pyspark.sql import functions as F

    fit = study.fit("Model 2")
    design = study.model2_design
    mm = {(r["chronological_age"], r["menopause_group"]): r["predicted_score"] for r in study.marginal_means.collect()}
    cov = study.covariate_distribution
    for age, group in ((75.0, "6.Surgical"), (65.0, "4.50-55 Natural (ref)")):
        pred = F.lit(0.0)
        for j, c in enumerate(design.columns):
            term = F.lit(float(fit.beta[j])) * F.lit((age - 65.0) ** c.power)
            for v, lv in c.factors:
                if v == "menopause_group":
                    term = term * F.lit(1.0 if lv == group else 0.0)
                else:
                    term = term * (F.col(v).cast("double") if lv is None else (F.col(v) == lv).cast("double"))
            pred = pred + term
        avg = cov.agg(F.avg(pred)).first()[0]
        assert abs(avg - mm[(age, group)]) < 1e-9


def test_loess_on_continuous_x(spark):
    """No rounding: exact and blended fits at unrounded x, two groups of very
    different sizes, against a direct computation."""
    from wavecohort.operators import describe as D

    draw = np.random.default_rng(4)
    rows = [("a", float(x), float(y)) for x, y in zip(draw.uniform(50, 90, 600), draw.uniform(0, 27, 600))]
    rows += [("b", float(x), float(y)) for x, y in zip(np.repeat(draw.uniform(55, 70, 20), 3), draw.uniform(0, 27, 60))]
    df = spark.createDataFrame(rows, "menopause_group string, chronological_age double, cognitive_score double").repartition(5)

    def fit(x, y, x0):
        dist = np.abs(x - x0)
        h = np.sort(dist)[int(0.75 * len(x)) - 1]
        w = np.where(dist < h, (1 - (dist / h) ** 3) ** 3, 0.0)
        X = np.column_stack([np.ones_like(x), x - x0, (x - x0) ** 2])
        return np.linalg.solve(X.T @ (w[:, None] * X), X.T @ (w * y))[:2]

    borders = D.cell_borders(D._loess_points(df, "chronological_age", "cognitive_score", "menopause_group", 50, (0, 27)), 0.75)
    exact, blended = D.loess_curve(df).toPandas(), D.loess_curve(df, surface="interpolate").toPandas()
    for g in "ab":
        x, y = (np.array([r[i] for r in rows if r[0] == g]) for i in (1, 2))
        b = np.array(borders[g])
        assert 5 <= len(b) <= 18 and b[0] < x.min() and b[-1] > x.max()
        inside = np.histogram(x, b)[0]
        assert inside.max() <= 0.15 * len(x) + (2 if g == "b" else 0)
        at = [fit(x, y, v) for v in b]
        for _, row in exact[exact.menopause_group == g].iloc[::13].iterrows():
            assert abs(fit(x, y, row.chronological_age)[0] - row["fit"]) < 1e-7
        for _, row in blended[blended.menopause_group == g].iloc[::13].iterrows():
            k = np.searchsorted(b, row.chronological_age, side="right") - 1
            w = b[k + 1] - b[k]
            t = (row.chronological_age - b[k]) / w
            want = ((1 - t) ** 2 * (1 + 2 * t) * at[k][0] + t * t * (3 - 2 * t) * at[k + 1][0]
                    + w * (t * (1 - t) ** 2 * at[k][1] - t * t * (1 - t) * at[k + 1][1]))
            assert abs(want - row["fit"]) < 1e-7


def test_quantiles_by_group(spark):
    """Groups of one value, of ties, and one that holds most rows."""
    from wavecohort.functions.quantile import quantiles_by_group

    draw = np.random.default_rng(5)
    values = {"one": [3.0], "ties": [2.0] * 50 + [7.0], "hot": list(draw.normal(size=4000)), "two": [1.0, 2.0]}
    rows = [(g, i % 2, float(v)) for g, vs in values.items() for i, v in enumerate(vs)] + [("none", 0, None), ("hot", 0, float("nan"))]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(6)
    got = {(r.g, r.h): r for r in quantiles_by_group(df, ["g", "h"], "v", {"a": 0.01, "m": 0.5, "z": 1.0}).collect()}
    for g, vs in values.items():
        for h in (0, 1):
            x = np.array(vs[h::2])
            assert ((g, h) in got) == bool(len(x))
            if len(x):
                assert got[g, h].n == len(x) and np.allclose([got[g, h][c] for c in "amz"], np.quantile(x, [0.01, 0.5, 1.0]), atol=1e-12)
    assert ("none", 0) not in got
