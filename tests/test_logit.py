"""Logistic fits: against NumPy, separation, dependent columns, extremes."""

import numpy as np
import pytest

from wavecohort.operators import logit as L


def table(spark, x, y):
    rows = [(*map(float, r), int(v)) for r, v in zip(x, y)]
    names = [f"x{i}" for i in range(len(x[0]))]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y int"), names


def newton(x, y):
    X = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(X.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-X @ b))
        b = b + np.linalg.solve(X.T @ ((p * (1 - p))[:, None] * X), X.T @ (y - p))
    p = 1 / (1 + np.exp(-X @ b))
    eta = X @ b
    return b, np.linalg.inv(X.T @ ((p * (1 - p))[:, None] * X)), 2 * (np.logaddexp(0, eta) - y * eta).sum()


def drawn(n=400, seed=1, scale=1.0):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 3)) * [1, 5, 0.1] + [0, 60, 0]
    eta = scale * (-6 + x @ [0.8, 0.1, 2.0])
    return x, (draw.random(n) < 1 / (1 + np.exp(-eta))).astype(int)


def test_two_models_in_the_same_passes(spark):
    x, y = drawn()
    df, names = table(spark, x, y)
    fitted = L.fit_logits(df, {"all": names, "one": names[:1]}, "y")
    for name, use in (("all", x), ("one", x[:, :1])):
        model, terms, _ = fitted[name]
        beta, covariance, deviance = newton(use, y)
        assert np.allclose([model.intercept, *model.coefficients], beta, rtol=1e-8)
        assert np.allclose(model.covariance, covariance, rtol=1e-6) and model.deviance == pytest.approx(deviance)
        assert model.converged and model.scaled_score < 1e-8 and model.n == len(y) and model.passes < 10
    assert [tuple(r) for r in L.certificate(spark, fitted).collect()] == [("all", 400, 4, True, True, 0), ("one", 400, 2, True, True, 0)]


def test_steep_but_not_separated(spark):
    x, y = drawn(scale=12.0)
    df, names = table(spark, x, y)
    model = L.fit_logits(df, {"m": names}, "y")["m"][0]
    assert np.allclose([model.intercept, *model.coefficients], newton(x, y)[0], rtol=1e-6)


def test_complete_separation_is_refused(spark):
    x, _ = drawn()
    df, names = table(spark, x, (x[:, 1] > 60).astype(int))
    with pytest.raises(L.Separated, match="m: .*x1"):
        L.fit_logits(df, {"m": names}, "y")


def test_quasi_separation_is_refused(spark):
    """One rare level has one outcome only."""
    x, y = drawn()
    x = np.column_stack([x, np.arange(len(x)) % 80 == 0])
    y[::80] = 1
    df, names = table(spark, x, y)
    with pytest.raises(L.Separated, match="by x3;"):
        L.fit_logits(df, {"m": names}, "y")


def test_one_outcome_only(spark):
    x, y = drawn(60)
    df, names = table(spark, x, np.ones_like(y))
    with pytest.raises(L.Separated):
        L.fit_logits(df, {"m": names}, "y")


def test_dependent_columns_are_named(spark):
    x, y = drawn()
    x = np.column_stack([x, x[:, 0] * 2 + 3, np.zeros(len(x))])
    df, names = table(spark, x, y)
    model = L.fit_logits(df, {"m": names}, "y")["m"][0]
    assert model.dropped == ["x3", "x4"] and model.coefficients[3:] == [0, 0] and np.isnan(model.std_errors[4:]).all()
    assert np.allclose([model.intercept, *model.coefficients[:3]], newton(x[:, :3], y)[0], rtol=1e-7)


def test_not_converged(spark):
    df, names = table(spark, *drawn())
    with pytest.raises(L.NotConverged):
        L.fit_logits(df, {"m": names}, "y", max_iter=1)
