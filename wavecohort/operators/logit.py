"""Logistic models by Newton steps on distributed sums.

A pass over the rows gives, for every model at its coefficients, the score X'r,
the information X'WX, the deviance and the extremes of the linear predictor:
plain sums of Column expressions, added up per task before they meet. Several
models (other terms, the same outcome) share a pass. The driver holds p numbers
and a p x p matrix per model and takes the Newton step.

A fit is certified by its own score: it has converged when the step that is
left is smaller than rounding, and the score at the final coefficients is part
of the result. Where outcomes are separated no maximum exists: some direction of
the coefficients raises (or keeps) the likelihood of every row, and the steps
run along it. So where fitted probabilities come close to 0 or 1, the last step
is tested against all rows, and separated outcomes are refused with the names
of the columns that separate them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep
from .design import FACTORS, used_levels
from .lmm import independent_columns


class NotConverged(RuntimeError):
    pass


class Separated(ValueError):
    """The outcome is separated by some columns; no finite estimates exist."""


INTERCEPT = "(Intercept)"
FAR = 15.0  # a linear predictor beyond it is within 3e-7 of 0 or 1
DONE = 1e-18  # Newton decrement


def feature(name: str) -> tuple[str, Column]:
    """(name, expression) of a column named variable + level, or variable."""
    for v in FACTORS:
        if name.startswith(v):
            return name, (F.col(v) == name[len(v):]).cast("double")
    return name, F.col(name).cast("double")


def features(terms: Sequence[str], levels: dict) -> list[tuple[str, Column]]:
    """Treatment-contrast columns in term order."""
    return [feature(t + lv if lv else t) for t in terms for lv in (levels[t][1:] if t in levels else [""])]


@dataclass
class Sums:
    n: int
    score: np.ndarray
    information: np.ndarray
    deviance: float
    low: float  # extremes of the linear predictor
    high: float


def _linear(x: Sequence[Column], beta: Sequence[float]) -> Column:
    eta = F.lit(0.0)
    for b, c in zip(beta, x):
        eta = eta + F.lit(float(b)) * c
    return eta


def sum_columns(y: Column, x: Sequence[Column], beta: Sequence[float], prefix: str) -> tuple[list[dict], list[Column]]:
    """(columns to add to the rows in three layers, aggregates over them) of
    one model; the first of ``x`` is the constant 1."""
    eta, p = F.col(f"{prefix}_eta"), F.col(f"{prefix}_p")
    rows = {f"{prefix}_eta": _linear(x, beta), f"{prefix}_y": y}
    y = F.col(f"{prefix}_y")
    # log(1 + e^eta) without overflow
    loss = F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta))) - y * eta
    w, r = F.col(f"{prefix}_w"), F.col(f"{prefix}_r")
    aggs = [F.count(F.lit(1)).alias(f"{prefix}_n"), F.sum(2 * loss).alias(f"{prefix}_dev"),
            F.min(eta).alias(f"{prefix}_low"), F.max(eta).alias(f"{prefix}_high")]
    for i in range(len(x)):
        aggs.append(F.sum(r * x[i]).alias(f"{prefix}_s{i}"))
        aggs += [F.sum(w * x[i] * x[j]).alias(f"{prefix}_i{i}_{j}") for j in range(i, len(x))]
    return [rows, {f"{prefix}_p": 1 / (1 + F.exp(-eta))}, {f"{prefix}_w": p * (1 - p), f"{prefix}_r": y - p}], aggs


def evaluate(rows: DataFrame, y: str, models: dict[str, tuple[Sequence[Column], Sequence[float]]]) -> dict[str, Sums]:
    """The sums of every model (its columns and coefficients) in one pass."""
    layers: list[dict] = [{}, {}, {}]
    aggs: list[Column] = []
    for m, (x, beta) in enumerate(models.values()):
        added, own = sum_columns(F.col(y).cast("double"), x, beta, f"_m{m}")
        for layer, more in zip(layers, added):
            layer.update(more)
        aggs += own
    for layer in layers:
        rows = rows.withColumns(layer)
    row = rows.agg(*aggs).first()  # one row
    out = {}
    for m, (name, (x, _)) in enumerate(models.items()):
        k, pre = len(x), f"_m{m}"
        score = np.array([row[f"{pre}_s{i}"] or 0.0 for i in range(k)])
        info = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                info[i, j] = info[j, i] = row[f"{pre}_i{i}_{j}"] or 0.0
        out[name] = Sums(row[f"{pre}_n"], score, info, row[f"{pre}_dev"] or 0.0, row[f"{pre}_low"] or 0.0, row[f"{pre}_high"] or 0.0)
    return out


@dataclass
class LogitModel:
    """Coefficients with what certifies them."""

    intercept: float
    coefficients: list[float]
    covariance: np.ndarray | None = None  # the intercept first
    deviance: float = float("nan")
    n: int = 0
    passes: int = 0
    scaled_score: float = float("nan")  # the largest score in units of its standard deviation
    converged: bool = True
    dropped: list[str] = field(default_factory=list)

    @property
    def std_errors(self) -> list[float]:
        """The intercept's first."""
        if self.covariance is None:
            return [float("nan")] * (1 + len(self.coefficients))
        return [math.sqrt(v) if v > 0 else float("nan") for v in np.diag(self.covariance)]


class _Search:
    """One model's way to its maximum."""

    def __init__(self, names: list[str]):
        self.names, self.kept = names, list(range(len(names)))
        self.beta = np.zeros(len(names))
        self.step = np.zeros(len(names))
        self.before: tuple[np.ndarray, float] | None = None
        self.sums: Sums | None = None
        self.passes, self.decrement, self.done = 0, math.inf, False

    def digest(self, sums: Sums, max_iter: int) -> None:
        """Digest the sums at ``beta`` and move on."""
        self.passes += 1
        if self.passes == 1:  # the weights are equal: X'WX has the rank of X
            self.kept = independent_columns(sums.information)
        if self.before is not None and sums.deviance > self.before[1] * (1 + 1e-9) + 1e-9:
            self.step = self.step / 2
            self.beta = self.before[0] + self.step
            self.done = self.passes > max_iter
            return
        self.sums = sums
        some = np.ix_(self.kept, self.kept)
        step = np.zeros(len(self.names))
        try:
            step[self.kept] = np.linalg.solve(sums.information[some], sums.score[self.kept])
        except np.linalg.LinAlgError:
            self.done = True
            return
        self.decrement = float(step @ sums.score)
        if self.decrement < DONE or self.passes > max_iter:
            self.done = True
            return
        self.before, self.step = (self.beta, sums.deviance), step
        self.beta = self.beta + step

    @property
    def converged(self) -> bool:
        return self.decrement < DONE

    def along(self) -> list[str]:
        """The columns that the last step moves along, in units of a row's
        linear predictor."""
        spread = np.sqrt(np.diag(self.sums.information) / max(self.sums.information[0, 0], 1e-300))
        reach = np.abs(self.step) * spread
        names = [n for n, r in zip(self.names, reach) if n != INTERCEPT and r > 0.1 * reach.max()]
        return names or [INTERCEPT]


def separating(rows: DataFrame, y: str, x: Sequence[Column], direction: np.ndarray) -> bool:
    """Whether no row loses likelihood along ``direction`` and some gain."""
    gain = (2 * F.col(y).cast("double") - 1) * _linear(x, direction)
    row = rows.agg(F.min(gain).alias("low"), F.max(gain).alias("high")).first()  # one row
    return row["high"] is not None and row["high"] > 0 and row["low"] >= -1e-5 * row["high"]


def fit_logits(rows: DataFrame, models: dict[str, Sequence[str]], label: str, max_iter: int = 50) -> dict[str, tuple]:
    """name -> (model, column names, (name, expression) of the columns) of every
    model's terms; factor levels that no row has are left out, columns that
    depend on earlier ones are named in ``dropped`` with coefficient 0.

    Raises ``Separated`` and ``NotConverged``."""
    facs = {t: FACTORS[t] for terms in models.values() for t in terms if t in FACTORS}
    used = used_levels(rows, facs)
    levels = {f: [facs[f][0]] + [lv for lv in facs[f][1:] if lv in used[f]] for f in facs}
    cols = {name: features(terms, levels) for name, terms in models.items()}
    every = {n: e for feats in cols.values() for n, e in feats}
    place = {n: F.col(f"_x{i}") for i, n in enumerate(every)}
    # one narrow table for all passes instead of the wide rows
    narrow = keep(rows.select(F.col(label).cast("double").alias("_y"), *[e.alias(f"_x{i}") for i, e in enumerate(every.values())]))
    x = {name: [F.lit(1.0), *[place[n] for n, _ in feats]] for name, feats in cols.items()}
    searches = {name: _Search([INTERCEPT, *[n for n, _ in feats]]) for name, feats in cols.items()}
    try:
        while any(not s.done for s in searches.values()):
            todo = {name: (x[name], s.beta) for name, s in searches.items() if not s.done}
            for name, sums in evaluate(narrow, "_y", todo).items():
                s = searches[name]
                s.digest(sums, max_iter)
                far = max(-sums.low, sums.high) > FAR
                if far and separating(narrow, "_y", x[name], s.step):
                    raise Separated(f"{name}: the outcome {label} is separated by {', '.join(s.along())}; no finite estimates exist")
        for name, s in searches.items():
            if not s.converged:
                raise NotConverged(f"the logistic model {name} of {label} did not converge in {max_iter} iterations")
    finally:
        narrow.unpersist()
    return {name: (_model(s), s.names[1:], cols[name]) for name, s in searches.items()}


def _model(s: _Search) -> LogitModel:
    sums, k = s.sums, s.kept
    covariance = np.full((len(s.names),) * 2, np.nan)
    covariance[np.ix_(k, k)] = np.linalg.inv(sums.information[np.ix_(k, k)])
    scaled = np.abs(sums.score[k]) / np.sqrt(np.diag(sums.information)[k])
    dropped = [n for j, n in enumerate(s.names) if j not in k]
    return LogitModel(float(s.beta[0]), [float(b) for b in s.beta[1:]], covariance, sums.deviance, sums.n, s.passes,
                      float(scaled.max()), s.converged, dropped)


def sums_table(rows: DataFrame, label: str, models: dict[str, tuple[Sequence[str], Sequence[Column], Sequence[float]]]) -> DataFrame:
    """(model, statistic, term, other_term, value): score, information (upper
    triangle) and deviance of models at given coefficients, per row of the
    data, as a table."""
    found = evaluate(rows, label, {name: (x, beta) for name, (_, x, beta) in models.items()})
    out = []
    for name, (terms, _, _) in models.items():
        s = found[name]
        n = max(1, s.n)
        out.append((name, "deviance", None, None, s.deviance / n))
        for i, a in enumerate(terms):
            out.append((name, "score", a, None, float(s.score[i]) / n))
            out += [(name, "information", a, b, float(s.information[i, i + j]) / n) for j, b in enumerate(terms[i:])]
    return rows.sparkSession.createDataFrame(out, "model string, statistic string, term string, other_term string, value double")


def certificate(spark, fitted: dict[str, tuple], tolerance: float = 1e-8) -> DataFrame:
    """One row per fitted model: rows, columns, and whether it converged with
    a score below ``tolerance`` standard deviations."""
    rows = [(name, int(m.n), 1 + len(names), bool(m.converged), bool(m.scaled_score < tolerance), len(m.dropped))
            for name, (m, names, _) in fitted.items()]
    return spark.createDataFrame(rows, "model string, n_rows long, n_columns int, converged boolean, score_is_zero boolean, n_dropped int")
