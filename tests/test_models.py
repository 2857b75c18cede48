"""Numerics: mixed model vs a dense likelihood and the expected fixture
values; tails; exact quantiles."""

import math

import numpy as np
import pytest

from wavecohort.functions import dist
from wavecohort.functions.quantile import exact_quantiles
from wavecohort.operators import design as DS
from wavecohort.operators import lmm as M


def _dense_deviance(ids, X, Z, y, w, theta):
    """-2 log L of the ML mixed model with beta and sigma profiled out."""
    T = np.array([[theta[0], 0.0], [theta[1], theta[2]]])
    n = len(y)
    Vs = {}
    XtVX = np.zeros((X.shape[1], X.shape[1]))
    XtVy = np.zeros(X.shape[1])
    logdet = 0.0
    for i in np.unique(ids):
        m = ids == i
        Vi = np.diag(1 / w[m]) + Z[m] @ T @ T.T @ Z[m].T
        Vinv = np.linalg.inv(Vi)
        Vs[i] = Vinv
        XtVX += X[m].T @ Vinv @ X[m]
        XtVy += X[m].T @ Vinv @ y[m]
        logdet += np.linalg.slogdet(Vi)[1]
    b = np.linalg.solve(XtVX, XtVy)
    r2 = sum(float((y[ids == i] - X[ids == i] @ b) @ Vs[i] @ (y[ids == i] - X[ids == i] @ b)) for i in Vs)
    return logdet + n * (1 + math.log(2 * math.pi * r2 / n)), b


@pytest.mark.parametrize("weighted", [False, True])
def test_lmm_matches_dense_likelihood(spark, weighted):
    rng = np.random.default_rng(7)
    rows = []
    groups = ["4.50-55 Natural (ref)", "1.Premature Natural", "6.Surgical"]
    for i in range(60):
        g = groups[i % 3]
        k = 1 + i % 6
        u0, u1 = rng.normal(0, 2), rng.normal(0, 0.2)
        for j in range(k):
            a = -10 + 3 * j + rng.normal()
            y = 12 + u0 + (-0.4 + u1) * a + (0.5 if g == "6.Surgical" else 0) + rng.normal(0, 1.3)
            w = float(rng.uniform(0.5, 2.0)) if weighted else 1.0
            rows.append((i, j, float(a), float(y), g, "Non-Hispanic White", 0.0, 0.0, w))
    df = spark.createDataFrame(rows, "hhidpn long, wave int, age_c65 double, cognitive_score double, menopause_group string, "
                                     "race_ethnicity string, birth_year_c10 double, education_c12 double, w double")
    terms = [("menopause_group",), ("age_c65",), ("menopause_group", "age_c65")]
    design = DS.drop_unused(DS.expand(terms), {"menopause_group": set(groups)})
    mom = M.person_moments(df, weight="w" if weighted else None)
    fit = M.fit_lmm(mom.cache(), design, "t")
    ids = np.array([r[0] for r in rows])
    a = np.array([r[2] for r in rows])
    y = np.array([r[3] for r in rows])
    w = np.array([r[8] for r in rows])
    g = np.array([r[4] for r in rows])
    X = np.column_stack([np.ones_like(a), g == groups[1], g == groups[2], a, (g == groups[1]) * a, (g == groups[2]) * a]).astype(float)
    Z = np.column_stack([np.ones_like(a), a])
    dev, b = _dense_deviance(ids, X, Z, y, w, fit.theta)
    assert abs(dev - fit.deviance) < 1e-6 * abs(dev)
    assert np.allclose(b, fit.beta, atol=1e-8)
    # the optimum: no nearby theta is better
    for d in np.eye(3) * 1e-2:
        assert _dense_deviance(ids, X, Z, y, w, fit.theta + d)[0] >= dev - 1e-6
        assert _dense_deviance(ids, X, Z, y, w, fit.theta - d)[0] >= dev - 1e-6


def test_models_0_and_2_expected_values(spark):
    """FIXTURES.md part 3 (sf0.01), tolerance 1e-3."""
    from wavecohort.plans.study import Study

    s = Study.from_orders(spark, "/root/testdata/sf0.01")
    f0 = s.fit("Model 0")
    assert (f0.n_obs, f0.n_persons, f0.p) == (3101, 678, 2)
    assert abs(f0.deviance - 14271.3799) < 1e-3
    assert np.allclose(f0.beta, [11.41222, -0.43713], atol=1e-3)
    assert np.allclose(np.sqrt(np.diag(f0.vcov)), [0.19727, 0.01001], atol=1e-4)
    assert abs(f0.sigma2 - 2.13467) < 1e-3
    f2 = s.fit("Model 2")
    assert (f2.n_obs, f2.n_persons, f2.p) == (3004, 655, 18)
    assert abs(f2.deviance - 13156.9902) < 1e-3
    k = 18 + 4
    assert abs(f2.deviance + 2 * k - 13200.9902) < 1e-3
    expected = {"(Intercept)": (6.76213, 0.39426), "menopause_group6.Surgical": (1.52415, 0.48858),
                "birth_year_c10": (-4.42712, 0.16570), "menopause_group6.Surgical:age_c65": (0.26718, 0.02919)}
    for term, (est, se) in expected.items():
        j = f2.terms.index(term)
        assert abs(f2.beta[j] - est) < 1e-3 and abs(math.sqrt(f2.vcov[j, j]) - se) < 1e-3
    G = f2.varcorr()
    assert abs(G[0, 0] - 10.76898) < 1e-2 and abs(G[1, 1] - 0.015921) < 1e-4


def test_tails_against_tables():
    assert abs(dist.f_sf(3.0, 5, 100) - 0.01449) < 1e-4
    assert abs(dist.chi2_sf(11.0705, 5) - 0.05) < 1e-4
    assert abs(dist.t_ppf(0.975, 10) - 2.228139) < 1e-5
    assert abs(dist.t_sf2(2.0, 10) - 0.073388) < 1e-5
    assert abs(dist.norm_sf2(1.959964) - 0.05) < 1e-6


@pytest.mark.parametrize("z,tail", [(9.0, 2.2571768119076845e-19), (20.0, 5.507248237212466e-89), (37.0, 1.1451142446062e-299)])
def test_normal_tail_far_out(z, tail):
    assert abs(dist.norm_sf2(z) / tail - 1) < 1e-10
    assert dist.norm_sf2(-z) == dist.norm_sf2(z)


@pytest.mark.parametrize("df", [1e6, 1e8, 1e9, 1e11, 1e12])
def test_tails_at_large_df(df):
    import math

    for t in (0.5, 2.0, 6.0):  # first-order expansion about the normal tail
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        want = math.erfc(t / math.sqrt(2)) + density * (t**3 + t) / (2 * df)
        second = (t**4 / (4 * df)) ** 2  # what the expansion leaves out
        assert abs(dist.t_sf2(t, df) / want - 1) < second + 200 / df**2 + 1e-11
    assert abs(dist.t_ppf(0.975, df) - dist.Z975) < 3 / df + 1e-9
    limit = dist.chi2_sf(7.5, 5)
    assert abs(dist.f_sf(1.5, 5, df) / limit - 1) < 30 / df + 1e-9
    assert 0.4 < dist.f_sf(1.0, df, df) < 0.6


def test_large_df_joins_the_exact_evaluation():
    for t in (1.0, 3.0, 8.0):
        exact = dist.betainc(5e4 - 1, 0.5, 1 / (1 + t * t / (1e5 - 2)), t * t / (1e5 - 2 + t * t))
        assert abs(dist.t_sf2(t, 1e5) / exact - 1) < 1e-3


@pytest.mark.parametrize("n", [8000, 333, 7, 1])
def test_exact_quantiles_match_type7(spark, n):
    rng = np.random.default_rng(n)
    x = np.concatenate([rng.lognormal(size=n - n // 3), np.ones(n // 3)])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "w double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = exact_quantiles(df, "w", probs)
    assert np.allclose(got, np.quantile(x, probs), rtol=0, atol=1e-12)
    assert np.isnan(exact_quantiles(df.where("w is null"), "w", [0.5])).all()


def _growth_rows(spark, education):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(150):
        b0, b1 = rng.normal(0, 2), rng.normal(0, 0.2)
        group = ["4.50-55 Natural (ref)", "6.Surgical"][i % 2]
        race = ["Non-Hispanic White", "Non-Hispanic Black"][i % 3 == 0]
        for j in range(5):
            a = 2.0 * j - 4
            rows.append((i, j, a, float(18 + b0 + (b1 - 0.1) * a + rng.normal()), group, race, float(i % 7), education(i)))
    return spark.createDataFrame(rows, "hhidpn long, wave int, age_c65 double, cognitive_score double, menopause_group string, "
                                       "race_ethnicity string, birth_year_c10 double, education_c12 double")


def test_rank_deficient_design_drops_and_names_the_column(spark):
    terms = [("age_c65",), ("birth_year_c10",), ("education_c12",)]
    fits = {}
    for name, education in (("zero", lambda i: 0.0), ("constant", lambda i: 3.0), ("collinear", lambda i: 2.0 * (i % 7) + 1)):
        mom = M.person_moments(_growth_rows(spark, education)).cache()
        fits[name] = M.fit_lmm(mom, DS.expand(terms), name)
        assert fits[name].dropped == ["education_c12"] and fits[name].converged
        assert "education_c12" in M.fit_stats(spark, fits[name]).first()["convergence_messages"]
    plain = M.fit_lmm(mom, DS.expand(terms[:2]), "plain")
    for fit in fits.values():
        assert fit.terms == plain.terms
        assert np.allclose(fit.beta, plain.beta, atol=1e-5) and abs(fit.deviance - plain.deviance) < 1e-6


def test_a_stalled_fit_says_so(spark):
    mom = M.person_moments(_growth_rows(spark, lambda i: float(i % 5))).cache()
    with pytest.warns(UserWarning, match="did not converge"):
        fit = M.fit_lmm(mom, DS.expand([("age_c65",)]), "short", max_iter=1)
    assert not fit.converged
    assert M.fixed_effects(spark, fit).select("converged").distinct().collect()[0][0] is False
    assert "did not converge" in M.fit_stats(spark, fit).first()["convergence_messages"]


def test_logit_that_does_not_converge_is_refused(spark):
    from wavecohort.operators import ipcw as W

    rows = [(i, float(i % 9), int((i * 7919) % 13 < 6)) for i in range(300)]
    risk = spark.createDataFrame(rows, "hhidpn long, education_c12 double, observed_t int")
    with pytest.raises(W.NotConverged):
        W.fit_logit(risk, ("education_c12",), max_iter=1)
    assert W.fit_logit(risk, ("education_c12",))[1] == ["education_c12"]


def test_model_roundtrip_and_tables(spark, tmp_path):
    rows = [(i, j, float(j * 2 - 5), float(10 + (i % 5) - 0.3 * (j * 2 - 5) + ((i * 7 + j) % 3)), "4.50-55 Natural (ref)",
             "Non-Hispanic White", 0.0, 0.0) for i in range(40) for j in range(1 + i % 4)]
    df = spark.createDataFrame(rows, "hhidpn long, wave int, age_c65 double, cognitive_score double, menopause_group string, "
                                     "race_ethnicity string, birth_year_c10 double, education_c12 double")
    design = DS.expand([("age_c65",)])
    fit = M.fit_lmm(M.person_moments(df).cache(), design, "m")
    path = str(tmp_path / "model")
    M.save_model(spark, fit, path)
    back = M.load_model(spark, path)
    assert back.terms == fit.terms and np.allclose(back.beta, fit.beta) and np.allclose(back.vcov, fit.vcov)
    assert back.deviance == fit.deviance and np.allclose(back.theta, fit.theta)
    fe = M.fixed_effects(spark, fit).collect()
    assert [r["term"] for r in fe] == ["(Intercept)", "age_c65"]
    for r in fe:
        assert r["conf_low"] < r["estimate"] < r["conf_high"]
    vc = M.variance_components(spark, fit).collect()
    assert vc[-1]["group"] == "Residual" and abs(vc[-1]["variance_or_covariance"] - fit.sigma2) < 1e-12
    st = M.fit_stats(spark, fit).first()
    assert abs(st["aic"] - (fit.deviance + 2 * 6)) < 1e-9
    icc = M.icc_by_age(spark, fit, [0]).first()
    assert 0 <= icc["icc"] <= 1


def test_satterthwaite_df_matches_dense_computation(spark):
    """Satterthwaite df (lmerTest's definition for ML fits) recomputed on a
    dense NumPy likelihood: deviance(theta, sigma) with beta profiled,
    vcov = sigma^2 (X'V*^-1 X)^-1, Hessian and Jacobian by central
    differences."""
    rng = np.random.default_rng(11)
    rows = []
    groups = ["4.50-55 Natural (ref)", "6.Surgical"]
    for i in range(60):
        g = groups[i % 2]
        u0, u1 = rng.normal(0, 2), rng.normal(0, 0.25)
        for j in range(1 + i % 5):
            a = -8 + 3 * j + rng.normal()
            y = 12 + u0 + (-0.4 + u1) * a + (0.7 if g == "6.Surgical" else 0) + rng.normal(0, 1.2)
            rows.append((i, j, float(a), float(y), g, "Non-Hispanic White", 0.0, 0.0))
    df = spark.createDataFrame(rows, "hhidpn long, wave int, age_c65 double, cognitive_score double, menopause_group string, "
                                     "race_ethnicity string, birth_year_c10 double, education_c12 double")
    design = DS.drop_unused(DS.expand([("menopause_group",), ("age_c65",), ("menopause_group", "age_c65")]),
                            {"menopause_group": set(groups)})
    fit = M.fit_lmm(M.person_moments(df).cache(), design, "t")

    ids = np.array([r[0] for r in rows])
    a = np.array([r[2] for r in rows])
    y = np.array([r[3] for r in rows])
    s = (np.array([r[4] for r in rows]) == groups[1]).astype(float)
    X = np.column_stack([np.ones_like(a), s, a, s * a])
    Z = np.column_stack([np.ones_like(a), a])
    n = len(y)

    def parts(theta):
        T = np.array([[theta[0], 0.0], [theta[1], theta[2]]])
        XtX = np.zeros((4, 4))
        Xty = np.zeros(4)
        yty = 0.0
        ld = 0.0
        for i in np.unique(ids):
            m = ids == i
            V = np.eye(m.sum()) + Z[m] @ T @ T.T @ Z[m].T
            Vi = np.linalg.inv(V)
            XtX += X[m].T @ Vi @ X[m]
            Xty += X[m].T @ Vi @ y[m]
            yty += y[m] @ Vi @ y[m]
            ld += np.linalg.slogdet(V)[1]
        b = np.linalg.solve(XtX, Xty)
        return XtX, yty - Xty @ b, ld

    def dev(v):
        _, r2, ld = parts(v[:3])
        return ld + r2 / v[3] ** 2 + n * np.log(2 * np.pi * v[3] ** 2)

    def vcov(v):
        XtX, _, _ = parts(v[:3])
        return v[3] ** 2 * np.linalg.inv(XtX)

    v0 = np.append(fit.theta, math.sqrt(fit.sigma2))
    h = 1e-4
    H = np.zeros((4, 4))
    E = np.eye(4) * h
    for i in range(4):
        for j in range(4):
            H[i, j] = (dev(v0 + E[i] + E[j]) - dev(v0 + E[i] - E[j]) - dev(v0 - E[i] + E[j]) + dev(v0 - E[i] - E[j])) / (4 * h * h)
    A = 2 * np.linalg.inv(H)
    V0 = vcov(v0)
    assert np.allclose(V0, fit.vcov, rtol=1e-6)
    jac = [(vcov(v0 + E[k]) - vcov(v0 - E[k])) / (2 * h) for k in range(4)]
    for j in range(4):
        g = np.array([jk[j, j] for jk in jac])
        df_dense = 2 * V0[j, j] ** 2 / (g @ A @ g)
        assert abs(fit.df[j] - df_dense) < 1e-3 * df_dense, (j, fit.df[j], df_dense)
