"""Linear mixed growth models from distributed per-person moments.

Model: y_ij = x_ij b + b0_i + b1_i a_ij + e_ij, with a random intercept
and slope in a = age - 65 per person, ML estimation, optional prior
weights (residual variance sigma^2 / w_ij).

Execution:
1. ``person_moments``: one ``groupBy(id)`` of sums of w a^k (k<=4),
   w a^k y (k<=2), w y^2, n, ln w and the person's covariates. The panel
   is not read again; the moments are checkpointed (lineage cut).
2. ``_evaluate``: one ``mapInPandas`` pass scores candidate covariance
   parameters, vectorized over the persons of each Arrow batch,
   emitting one partial-sum vector per partition and theta, added up by
   a per-theta ``applyInPandas``.
3. The driver keeps 3 parameters and p x p matrices. A pass returns the
   deviance's exact gradient and Hessian beside its value, so a Newton step
   costs one pass, and the same sums yield the Satterthwaite df.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dist
from ..spec import DEFAULT_SPEC, PanelSpec
from .design import FACTORS, PERSON_COLUMNS, Design, coefficient, drop_unused, expand, used_levels


def person_moments(rows: DataFrame, y: str = "cognitive_score", time: str = "age_c65", weight: str | None = None,
                   spec: PanelSpec = DEFAULT_SPEC, extra: tuple = ("baseline_normal",)) -> DataFrame:
    """Sufficient statistics per person (key ``lmm_moments``).

    Person covariates are constant within a person, so their least value is
    taken, and a flag of min <> max is kept so that a violation is refused.
    """
    a = F.col(time).cast("double")
    yv = F.col(y).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(w * F.pow(a, k)).alias(f"s{k}") for k in range(5)]
    aggs += [F.sum(w * F.pow(a, k) * yv).alias(f"z{k}") for k in range(3)]
    aggs += [F.sum(w * yv * yv).alias("yy"), F.sum(F.log(w)).alias("lw")]
    covs = [c for c in PERSON_COLUMNS + tuple(extra) if c in rows.columns]
    aggs += [F.min(c).alias(c) for c in covs]
    # constancy check by min != max (count_distinct would add a shuffle)
    aggs.append(sum(F.coalesce((F.min(c) != F.max(c)).cast("int"), F.lit(0)) for c in covs).alias("_nonconstant"))
    return rows.groupBy(spec.id).agg(*aggs)


# ---- distributed evaluation ----------------------------------------------------

def _lower(theta):
    t = np.zeros((2, 2))
    t[0, 0], t[1, 0], t[1, 1] = theta
    return t


# The relative covariance of a person's effects is psi = T T'. Its three free
# entries and the directions in which they move it:
BASIS = np.array([[[1.0, 0], [0, 0]], [[0, 1], [1, 0]], [[0, 0], [0, 1]]])
PAIRS = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]


def _partials(batches, design: Design, thetas: np.ndarray, center: float, derive: int):
    """mapInPandas body. For each theta, summed over the partition's persons:
    the cross products of (X, y) under V^-1 (times sigma^2) and ln|A|; for the
    first ``derive`` thetas also their first and second derivatives in psi.

    With S = Z'WZ, P = (I + psi S)^-1, B = S P and G = P'Z'W(X, y), a step E of
    psi changes the cross products by -G'EG and ln|A| by tr(BE); two steps E, F
    change them by G'(FBE + EBF)G and -tr(BEBF)."""
    p = design.p
    powers = np.array([c.power for c in design.columns])
    acc = None
    for pdf in batches:
        if len(pdf) == 0:
            continue
        m = len(pdf)
        s = np.stack([pdf[f"s{k}"].to_numpy(float) for k in range(5)], axis=1)
        S = s[:, np.arange(3)[:, None] + np.arange(3)[None, :]]
        z = np.stack([pdf[f"z{k}"].to_numpy(float) for k in range(3)], axis=1)
        # centre y to limit cancellation: y* = y - c  (sums shift exactly)
        z = z - center * s[:, 0:3]
        yy = pdf["yy"].to_numpy(float) - 2 * center * pdf["z0"].to_numpy(float) + center * center * s[:, 0]
        cols = {c: pdf[c].to_numpy() for c in PERSON_COLUMNS if c in pdf}
        C = np.zeros((m, 3, p))
        for j, col in enumerate(design.columns):
            C[:, powers[j], j] = coefficient(cols, col)
        Szz = S[:, :2, :2]
        flat = C.reshape(m * 3, p)
        plain = np.zeros((p + 1, p + 1))  # cross products without random effects
        plain[:p, :p] = flat.T @ np.matmul(S, C).reshape(m * 3, p)
        plain[:p, p] = plain[p, :p] = flat.T @ z.reshape(m * 3)
        plain[p, p] = yy.sum()
        U = np.concatenate([np.matmul(S[:, :2, :], C), z[:, :2, None]], axis=2)  # Z'W(X, y): m x 2 x (p + 1)
        flat_u = U.reshape(m * 2, p + 1)
        size = [float(pdf["n"].sum()), float(pdf["lw"].sum())]
        out = []
        for t_id, theta in enumerate(thetas):
            psi = _lower(theta) @ _lower(theta).T
            A = np.eye(2)[None] + np.matmul(psi[None], Szz)
            P = np.linalg.inv(A)
            value = plain - flat_u.T @ np.matmul(np.matmul(P, psi[None]), U).reshape(m * 2, p + 1)
            parts = [value.ravel(), [np.log(np.linalg.det(A)).sum()], size]
            if t_id < derive:
                B = np.matmul(Szz, P)
                G = np.matmul(np.transpose(P, (0, 2, 1)), U)
                G0, G1 = G[:, 0, :], G[:, 1, :]
                cross = G0.T @ G1
                parts += [-(G0.T @ G0).ravel(), -(cross + cross.T).ravel(), -(G1.T @ G1).ravel()]
                parts.append([B[:, 0, 0].sum(), B[:, 0, 1].sum() + B[:, 1, 0].sum(), B[:, 1, 1].sum()])
                flat_g, BE = G.reshape(m * 2, p + 1), [np.matmul(B, E[None]) for E in BASIS]
                for i, j in PAIRS:
                    Q = np.matmul(BASIS[j][None], BE[i]) + np.matmul(BASIS[i][None], BE[j])
                    parts.append((flat_g.T @ np.matmul(Q, G).reshape(m * 2, p + 1)).ravel())
                parts.append([-np.einsum("mab,mba->", BE[i], BE[j]) for i, j in PAIRS])
            out.append(np.concatenate(parts))
        acc = out if acc is None else [a + b for a, b in zip(acc, out)]
    if acc is not None:
        # one row per theta per partition
        yield pd.DataFrame({"theta_id": np.arange(len(thetas), dtype="int32"), "vec": acc})


def _sum_vectors(pdf: pd.DataFrame) -> pd.DataFrame:
    """applyInPandas: add the per-partition vectors of one theta."""
    return pd.DataFrame({"theta_id": pdf["theta_id"].iloc[:1].to_numpy(), "vec": [np.sum(np.stack(pdf["vec"].to_numpy()), axis=0)]})


@dataclass
class Sums:
    """The sums of one theta: cross products of (X, y), ln|A|, observations and
    ln w; with ``derive`` their derivatives in psi."""

    theta: np.ndarray
    cross: np.ndarray
    ld: float
    n: float
    lw: float
    d1: np.ndarray | None = None  # 3 x (p + 1) x (p + 1)
    ld1: np.ndarray | None = None
    d2: dict | None = None  # pair -> (p + 1) x (p + 1)
    ld2: dict | None = None

    @classmethod
    def of(cls, theta, vec: np.ndarray, p: int) -> "Sums":
        q = (p + 1) ** 2
        first = cls(np.array(theta, float), vec[:q].reshape(p + 1, p + 1), vec[q], vec[q + 1], vec[q + 2])
        if len(vec) > q + 3:
            rest = vec[q + 3 :]
            first.d1, first.ld1 = rest[: 3 * q].reshape(3, p + 1, p + 1), rest[3 * q : 3 * q + 3]
            rest = rest[3 * q + 3 :]
            first.d2 = {pair: rest[k * q : (k + 1) * q].reshape(p + 1, p + 1) for k, pair in enumerate(PAIRS)}
            first.ld2 = dict(zip(PAIRS, rest[len(PAIRS) * q :]))
        return first

    @property
    def p(self) -> int:
        return len(self.cross) - 1

    @property
    def xtx(self) -> np.ndarray:
        return self.cross[:-1, :-1]

    @property
    def xty(self) -> np.ndarray:
        return self.cross[:-1, -1]

    def keep(self, kept: list[int]) -> "Sums":
        """The same sums for some of the design's columns."""
        both = np.ix_([*kept, self.p], [*kept, self.p])
        return Sums(self.theta, self.cross[both], self.ld, self.n, self.lw,
                    None if self.d1 is None else np.stack([d[both] for d in self.d1]), self.ld1,
                    None if self.d2 is None else {k: d[both] for k, d in self.d2.items()}, self.ld2)

    def profile(self):
        """beta, penalized RSS r2 and the ML deviance at this theta."""
        L = np.linalg.cholesky(self.xtx)
        beta = np.linalg.solve(self.xtx, self.xty)
        r2 = self.cross[-1, -1] - float(self.xty @ beta)
        dev = self.ld - self.lw + self.n * (1 + math.log(2 * math.pi * r2 / self.n))
        return beta, r2, dev, L

    def derivatives(self) -> "Derivatives":
        """Of ln|A|, r2 and X'V^-1X in theta, beta profiled out."""
        beta, r2, _, _ = self.profile()
        b = np.append(-beta, 1.0)  # r2 = b' cross b
        v = self.d1 @ b  # row k: the derivative of the cross products, times b
        inverse = np.linalg.inv(self.xtx)
        r2_1 = v @ b
        r2_2, ld_2 = np.zeros((3, 3)), np.zeros((3, 3))
        for i, j in PAIRS:
            moved = 2 * float(v[i, :-1] @ inverse @ v[j, :-1])  # beta moves with psi
            r2_2[i, j] = r2_2[j, i] = float(b @ self.d2[i, j] @ b) - moved
            ld_2[i, j] = ld_2[j, i] = self.ld2[i, j]
        t00, t10, t11 = self.theta
        J = np.array([[2 * t00, 0, 0], [t10, t00, 0], [0, 2 * t10, 2 * t11]])  # of psi in theta
        bend = np.array([np.diag([2.0, 0, 0]), [[0, 1.0, 0], [1, 0, 0], [0, 0, 0]], np.diag([0, 2.0, 2.0])])

        def chain(first, second):
            return J.T @ first, J.T @ second @ J + np.tensordot(first, bend, axes=1)

        xtx_1 = np.tensordot(J.T, self.d1[:, :-1, :-1], axes=1)
        return Derivatives(r2, self.n, *chain(self.ld1, ld_2), *chain(r2_1, r2_2), xtx_1, inverse)


@dataclass
class Derivatives:
    r2: float
    n: float
    ld1: np.ndarray
    ld2: np.ndarray
    r1: np.ndarray
    r2_2: np.ndarray
    xtx1: np.ndarray  # 3 x p x p
    inverse: np.ndarray  # of X'V^-1X

    def of_deviance(self) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the profiled deviance in theta."""
        share = self.n / self.r2
        return self.ld1 + share * self.r1, self.ld2 + share * (self.r2_2 - np.outer(self.r1, self.r1) / self.r2)

    def satterthwaite(self) -> np.ndarray:
        """lmerTest's degrees of freedom of each coefficient (ML), from the
        deviance as a function of (theta, sigma) with beta profiled out and the
        coefficients' covariance sigma^2 (X'V^-1X)^-1, all in closed form."""
        s2 = self.r2 / self.n
        sigma = math.sqrt(s2)
        H = np.zeros((4, 4))
        H[:3, :3] = self.ld2 + self.r2_2 / s2
        H[:3, 3] = H[3, :3] = -2 * self.r1 / sigma**3
        H[3, 3] = 6 * self.r2 / sigma**4 - 2 * self.n / s2
        p = len(self.inverse)
        try:
            A = 2 * np.linalg.inv(H)
        except np.linalg.LinAlgError:
            return np.full(p, np.nan)
        df = np.zeros(p)
        moved = [self.inverse @ d @ self.inverse for d in self.xtx1]
        for j in range(p):
            variance = s2 * self.inverse[j, j]
            g = np.array([*[-s2 * m[j, j] for m in moved], 2 * variance / sigma])
            spread = float(g @ A @ g)
            df[j] = 2 * variance * variance / spread if spread > 0 else np.nan
        return df


def _evaluate(moments: DataFrame, design: Design, thetas, center: float, derive: int = 0) -> list[Sums]:
    """One pass: each partition emits one partial-sum vector per theta; a
    per-theta ``applyInPandas`` adds them (a group holds one row per
    partition, bounded by the partition count, not by the data), so one
    row per theta reaches the driver."""
    thetas = np.asarray(thetas, float).reshape(-1, 3)
    schema = T.StructType([T.StructField("theta_id", T.IntegerType()), T.StructField("vec", T.ArrayType(T.DoubleType()))])
    part = moments.mapInPandas(lambda it: _partials(it, design, thetas, center, derive), schema)
    red = part.groupBy("theta_id").applyInPandas(_sum_vectors, schema)
    found = {r["theta_id"]: np.array(r["vec"]) for r in red.collect()}
    return [Sums.of(theta, found[i], design.p) for i, theta in enumerate(thetas)]


def independent_columns(xtx: np.ndarray, tolerance: float = 1e-10) -> list[int]:
    """The columns that aren't linear combinations of earlier ones, from the
    cross products: the share of a column's own square that earlier kept
    columns leave unexplained (R drops later columns first, as here)."""
    scale = np.sqrt(np.diag(xtx))
    kept: list[int] = []
    for j in range(len(xtx)):
        if not scale[j] > 0:
            continue
        left = 1.0
        if kept:
            inner = xtx[np.ix_(kept, kept)] / np.outer(scale[kept], scale[kept])
            cross = xtx[kept, j] / (scale[kept] * scale[j])
            left -= float(cross @ np.linalg.solve(inner, cross))
        if left > tolerance:
            kept.append(j)
    return kept


# ---- optimizer -----------------------------------------------------------------

@dataclass
class FittedMixedModel:
    name: str
    terms: list
    beta: np.ndarray
    vcov: np.ndarray
    theta: np.ndarray
    sigma2: float
    deviance: float
    n_obs: int
    n_persons: int
    df: np.ndarray
    passes: int
    dropped: list = field(default_factory=list)
    weights: str | None = None
    converged: bool = True
    decrement: float = float("nan")  # of the deviance, by another Newton step
    curvature: float = float("nan")  # least eigenvalue of the deviance's Hessian in theta

    @property
    def p(self):
        return len(self.beta)

    def varcorr(self):
        t = _lower(self.theta)
        G = self.sigma2 * t @ t.T
        return G


def fit_lmm(moments: DataFrame, design: Design, name: str = "model", weights: str | None = None,
            max_iter: int = 30, start=None) -> FittedMixedModel:
    """M2/M3: ML fit from person moments (checkpointed by the caller).

    A pass gives the deviance with its exact gradient and Hessian at the
    proposed theta, so an accepted Newton step costs one pass, and the pass of
    the last step gives the estimates, their covariance and the Satterthwaite
    df. Where a step fails, one pass scores shorter ones. The sign of the last
    parameter is free; t00, t11 >= 0.
    """
    agg = moments.agg(F.sum("n").alias("n"), F.sum("z0").alias("z0"), F.sum("s0").alias("s0"),
                      F.count(F.lit(1)).alias("persons"), F.max("_nonconstant").alias("nc")).first()
    if agg["nc"]:
        raise ValueError("person covariates vary within a person; resolve invariants first")
    center = agg["z0"] / agg["s0"]
    backs = np.array([0.5, 0.25, 0.1, 0.02])

    def dev_of(sums):
        try:
            return sums.profile()[2]
        except (np.linalg.LinAlgError, ValueError):
            return np.inf

    def newton(g, H, radius):
        # |eigenvalues| turn negative curvature into descent; the trust
        # radius keeps early steps (far from the optimum) bounded
        w, V = np.linalg.eigh(H)
        w = np.maximum(np.abs(w), 1e-8 * max(1.0, np.abs(w).max()))
        st = -V @ ((V.T @ g) / w)
        norm = np.linalg.norm(st)
        return st * (radius / norm) if norm > radius else st

    theta = np.array(start if start is not None else [1.0, 0.0, 1.0], float)
    [sums] = _evaluate(moments, design, theta, center, 1)
    passes = 1
    # V is positive definite, so X'V^-1X has the rank of X
    kept = independent_columns(sums.xtx)
    if len(kept) < design.p:
        design = Design([design.columns[j] for j in kept],
                        [*design.dropped, *[c.name for j, c in enumerate(design.columns) if j not in kept]])
        sums = sums.keep(kept)
    f = dev_of(sums)
    if not np.isfinite(f):
        raise ValueError(f"{name}: the deviance isn't finite at the start; is the outcome or a weight degenerate?")
    radius = 1.0
    converged = False
    while True:
        found = sums.derivatives()
        g, H = found.of_deviance()
        step = newton(g, H, np.inf)
        decrement = abs(float(g @ step))  # the deviance that a full Newton step would still gain
        # below rounding of the deviance nothing can be gained
        converged = decrement < max(1e-11, 1e-15 * abs(f))
        if converged or radius < 1e-9 or passes > max_iter:
            break
        step = newton(g, H, radius)
        [ahead] = _evaluate(moments, design, theta + step, center, 1)
        passes += 1
        value = dev_of(ahead)
        if value < f + 1e-13 * abs(f):
            theta, f, sums = theta + step, value, ahead
            if np.linalg.norm(step) >= 0.99 * radius:
                radius *= 4
            continue
        values = [dev_of(x) for x in _evaluate(moments, design, theta[None, :] + backs[:, None] * step[None, :], center)]
        passes += 1
        best = int(np.argmin(values))
        radius = (backs[best] if values[best] < f else backs[-1] / 5) * np.linalg.norm(step)
    if theta[0] < 0:
        theta[0], theta[1] = -theta[0], -theta[1]
    theta[2] = abs(theta[2])
    beta, r2, dev, _ = sums.profile()
    n = sums.n
    sigma2 = r2 / n
    beta = beta.copy()
    beta[0] += center
    if not converged:
        warnings.warn(f"{name} did not converge in {passes} passes; its tables say so", stacklevel=2)
    return FittedMixedModel(name, design.names, beta, sigma2 * found.inverse, theta, sigma2, float(dev), int(n), int(agg["persons"]),
                            found.satterthwaite(), passes, design.dropped, weights, converged, decrement,
                            float(np.linalg.eigvalsh(H).min()))


def at_theta(moments: DataFrame, design: Design, theta, name: str = "model", weights: str | None = None) -> FittedMixedModel:
    """The model at given covariance parameters: estimates, residual variance,
    deviance and df by one pass, without a search."""
    sums = derivatives_at(moments, design, theta)
    beta, r2, dev, _ = sums.profile()
    found = sums.derivatives()
    sigma2 = r2 / sums.n
    persons = moments.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return FittedMixedModel(name, design.names, beta, sigma2 * found.inverse, np.asarray(theta, float), sigma2, float(dev),
                            int(sums.n), int(persons), found.satterthwaite(), 1, design.dropped, weights)


def derivatives_at(moments: DataFrame, design: Design, theta) -> Sums:
    [sums] = _evaluate(moments, design, [theta], 0.0, 1)
    return sums


def gradient_table(spark: SparkSession, models: dict[str, Sums]) -> DataFrame:
    """(model, i, j, gradient, hessian): the deviance's derivatives in theta at
    given covariance parameters, per observation."""
    rows = []
    for name, sums in models.items():
        g, H = sums.derivatives().of_deviance()
        rows += [(name, i, j, float(g[i] / sums.n), float(H[i, j] / sums.n)) for i in range(3) for j in range(3)]
    return spark.createDataFrame(rows, "model string, i int, j int, gradient double, hessian double")


def certificate(spark: SparkSession, fits: list[FittedMixedModel], tolerance: float = 1e-8) -> DataFrame:
    """One row per fit: whether its optimum is certified, i.e. another Newton
    step would change the deviance by less than ``tolerance`` and the Hessian
    is positive definite."""
    rows = [(f.name, f.n_obs, f.n_persons, bool(f.converged), bool(f.decrement < tolerance), bool(f.curvature > 0)) for f in fits]
    schema = "model string, n_person_waves long, n_persons long, converged boolean, gradient_is_zero boolean, hessian_is_positive boolean"
    return spark.createDataFrame(rows, schema)


# ---- result tables (M4-M10) ----------------------------------------------------

def fixed_effects(spark: SparkSession, fit: FittedMixedModel, label: str | None = None) -> DataFrame:
    """M4: estimate, se, Satterthwaite df, t CI, t and p."""
    rows = []
    for j, term in enumerate(fit.terms):
        est, se, d = float(fit.beta[j]), math.sqrt(fit.vcov[j, j]), float(fit.df[j])
        crit = dist.t_ppf(0.975, d) if np.isfinite(d) else dist.Z975
        t = est / se
        rows.append((label or fit.name, term, est, se, d if np.isfinite(d) else None, est - crit * se, est + crit * se, t,
                     dist.t_sf2(t, d), bool(fit.converged)))
    return spark.createDataFrame(
        rows,
        "model string, term string, estimate double, std_error double, df double, conf_low double, conf_high double, "
        "statistic double, p_value double, converged boolean",
    )


def variance_components(spark: SparkSession, fit: FittedMixedModel, label: str | None = None, id_name: str = "hhidpn") -> DataFrame:
    """M5: variances, covariance, residual; sd and correlation."""
    G = fit.varcorr()
    v0, v1, c01 = G[0, 0], G[1, 1], G[0, 1]
    cor = c01 / math.sqrt(v0 * v1) if v0 > 0 and v1 > 0 else float("nan")
    rows = [
        (label or fit.name, id_name, "(Intercept)", None, float(v0), math.sqrt(v0)),
        (label or fit.name, id_name, "age_c65", None, float(v1), math.sqrt(v1)),
        (label or fit.name, id_name, "(Intercept)", "age_c65", float(c01), float(cor)),
        (label or fit.name, "Residual", None, None, float(fit.sigma2), math.sqrt(fit.sigma2)),
    ]
    return spark.createDataFrame(
        rows, "model string, group string, effect_1 string, effect_2 string, variance_or_covariance double, sd_or_correlation double"
    )


def fit_stats(spark: SparkSession, fit: FittedMixedModel, label: str | None = None) -> DataFrame:
    """M6: n, persons, AIC, BIC, logLik, deviance, singular (theta
    diagonal < 1e-4), convergence message, weight name."""
    k = fit.p + 4
    aic = fit.deviance + 2 * k
    bic = fit.deviance + math.log(fit.n_obs) * k
    singular = bool(fit.theta[0] < 1e-4 or fit.theta[2] < 1e-4)
    msg = "None" if fit.converged else "did not converge"
    if fit.dropped:
        msg += " | dropped rank-deficient columns: " + ", ".join(fit.dropped)
    rows = [(label or fit.name, int(fit.n_obs), int(fit.n_persons), float(aic), float(bic), float(-fit.deviance / 2),
             float(fit.deviance), False, singular, fit.weights, msg)]
    return spark.createDataFrame(
        rows,
        "model string, n_person_waves long, n_persons long, aic double, bic double, log_likelihood double, "
        "deviance double, reml boolean, singular_fit boolean, weights string, convergence_messages string",
    )


def icc_by_age(spark: SparkSession, fit: FittedMixedModel, ages_c65, label: str | None = None) -> DataFrame:
    """M7: (t00 + 2a t01 + a^2 t11) / (that + residual) at given ages."""
    G = fit.varcorr()
    rows = []
    for a in ages_c65:
        b = G[0, 0] + 2 * a * G[0, 1] + a * a * G[1, 1]
        rows.append((label or fit.name, float(65 + a), float(a), float(b), float(fit.sigma2), float(b / (b + fit.sigma2)),
                     "Primary ICC at age 65 because age is centered at 65" if a == 0
                     else "Age-specific ICC implied by random intercept-slope covariance"))
    return spark.createDataFrame(
        rows, "model string, chronological_age double, age_c65 double, between_person_variance double, "
              "residual_variance double, icc double, interpretation string"
    )


def slope_differences(fixed: DataFrame, exclude_other: bool = False) -> DataFrame:
    """M8: group x age terms; ``exclude_other`` drops education and squared
    age terms (the sensitivity tables do)."""
    t = F.col("term")
    d = fixed.where(t.rlike("menopause_group.*:age_c65|age_c65:menopause_group"))
    if exclude_other:
        d = d.where(~t.rlike("education_c12|age_c65_sq"))
    contrast = F.regexp_replace(F.regexp_replace(t, "menopause_group", ""), ":age_c65", "")
    contrast = F.regexp_replace(contrast, "`", "")
    return d.select("model", contrast.alias("contrast"), "term", "estimate", "std_error", "df", "conf_low", "conf_high",
                    "statistic", "p_value")


def three_way_terms(fixed: DataFrame) -> DataFrame:
    """M9: group x age x education terms."""
    t = F.col("term")
    d = fixed.where(t.contains("menopause_group") & t.contains("age_c65") & t.contains("education_c12"))
    c = F.regexp_replace(t, "menopause_group", "")
    c = F.regexp_replace(c, ":age_c65", "")
    c = F.regexp_replace(c, ":education_c12", "")
    return d.select("model", c.alias("contrast"), "term", "estimate", "std_error", "df", "conf_low", "conf_high",
                    "statistic", "p_value")


def compare_models(stats: DataFrame) -> DataFrame:
    """AIC/BIC with deltas to the best model (a tiny frame)."""
    from pyspark.sql import Window

    w = Window.partitionBy()
    return stats.withColumns(
        {"delta_aic_vs_best": F.col("aic") - F.min("aic").over(w), "delta_bic_vs_best": F.col("bic") - F.min("bic").over(w)}
    )


def prepare_design(moments: DataFrame, terms, levels: dict | None = None) -> Design:
    """The design without columns of levels that no person has; ``moments``
    is any frame with the person factors, the per-person moments at best."""
    return drop_unused(expand(terms, levels), used_levels(moments, {f: FACTORS[f] for f in FACTORS if any(f in t for t in terms)}))


# ---- IO9 persistence ----------------------------------------------------------------

def model_table(spark: SparkSession, fit: FittedMixedModel) -> DataFrame:
    """A fitted model as one row per coefficient (vcov row, df) with the
    covariance parameters and fit statistics repeated on every row."""
    rows = [
        (fit.name, j, t, float(fit.beta[j]), [float(x) for x in fit.vcov[j]], float(fit.df[j]) if np.isfinite(fit.df[j]) else None,
         [float(x) for x in fit.theta], float(fit.sigma2), float(fit.deviance), int(fit.n_obs), int(fit.n_persons), int(fit.passes),
         list(fit.dropped), fit.weights, bool(fit.converged))
        for j, t in enumerate(fit.terms)
    ]
    return spark.createDataFrame(
        rows,
        "model string, j int, term string, estimate double, vcov array<double>, df double, theta array<double>, "
        "sigma2 double, deviance double, n_obs long, n_persons long, passes int, dropped array<string>, weights string, "
        "converged boolean",
    )


def save_model(spark: SparkSession, fit: FittedMixedModel, path: str) -> None:
    model_table(spark, fit).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> FittedMixedModel:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["j"])
    r0 = rows[0]
    return FittedMixedModel(
        r0["model"], [r["term"] for r in rows], np.array([r["estimate"] for r in rows]),
        np.array([r["vcov"] for r in rows]), np.array(r0["theta"]), r0["sigma2"], r0["deviance"], r0["n_obs"], r0["n_persons"],
        np.array([np.nan if r["df"] is None else r["df"] for r in rows]), r0["passes"], list(r0["dropped"] or []), r0["weights"],
        r0["converged"],
    )


def format_fixed_effects(fixed: DataFrame) -> DataFrame:
    """F8: the exported fixed-effect table as fixed-point strings."""
    from ..functions.exprs import fixed as fx
    from .describe import format_p

    return fixed.select(
        "model", "term",
        fx("estimate", 4).alias("estimate"), fx("std_error", 4).alias("std_error"), fx("df", 1).alias("df"),
        fx("conf_low", 4).alias("conf_low"), fx("conf_high", 4).alias("conf_high"), fx("statistic", 3).alias("statistic"),
        format_p("p_value").alias("p_value"),
    )
