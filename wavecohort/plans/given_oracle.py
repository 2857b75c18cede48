"""DuckDB SQL for the results at given coefficients (``given``).

Terms and formulas are written out here; only the coefficients themselves
are taken from ``given``.
"""

from __future__ import annotations

from ..operators.design import MODEL_NAMES
from ..spec import CONTRAST_GROUPS, GROUP_LABELS, GROUP_LEVELS, NATURAL_GROUPS, RACE_LEVELS, TABLE8_AGES, TRAJECTORY_AGES
from . import given as G
from .oracle import _f_tail, _fx, _in, _q, cte

Z975 = "1.959963984540054"


def tail(z: str) -> str:
    """The two-sided normal tail, by the series of the error function; 0
    beyond 8.5, where it is below 1e-16."""
    series = (f"list_sum(list_transform(range(0, 400), lambda k: exp(k * ln(({z}) * ({z})) + k * ln(2) + lgamma(k + 1) "
              f"- lgamma(2 * k + 2))))")  # fmt: skip
    return (f"case when {z} is null or isnan({z}) then null when abs({z}) > 8.5 then 0 when {z} = 0 then 1 "
            f"else greatest(0, 1 - 2 / sqrt(2 * pi()) * exp(-({z}) * ({z}) / 2) * abs({z}) * {series}) end")  # fmt: skip


def p_text(p: str) -> str:
    return f"case when {p} is null or isnan({p}) then '' when {p} < 0.001 then '<0.001' else {_fx(p, 3)} end"


def numbers(values) -> str:
    return ", ".join(repr(float(v)) for v in values)


# ---- logistic models --------------------------------------------------------------
def linear(intercept: float, coefficients: dict) -> str:
    out = [repr(intercept)]
    for name, value in coefficients.items():
        column = next((c for c in ("menopause_group", "race_ethnicity") if name.startswith(c)), None)
        x = f"(case when {column} = {_q(name[len(column):])} then 1.0 else 0.0 end)" if column else f"cast({name} as double)"
        out.append(f"({value!r} * {x})")
    return " + ".join(out)


def bounded(eta: str) -> str:
    return f"least(greatest(1 / (1 + exp(-({eta}))), 1e-4), 1 - 1e-4)"


cte("given_predictions", ("ipcw_risk_set",), f"""
select *, p_observed_numerator / p_observed_denominator as stabilized_transition_weight from (
  select hhidpn, wave, {bounded(linear(G.INTERCEPT["denominator"], G.DENOMINATOR))} as p_observed_denominator,
    {bounded(linear(G.INTERCEPT["numerator"], G.NUMERATOR))} as p_observed_numerator from ipcw_risk_set)""")


def column(name: str) -> str:
    factor = next((c for c in ("menopause_group", "race_ethnicity") if name.startswith(c)), None)
    return f"(case when {factor} = {_q(name[len(factor):])} then 1.0::double else 0 end)" if factor else f"cast({name} as double)"


def _logit_sums(model: str, intercept: float, coefficients: dict) -> str:
    names = ["(Intercept)", *coefficients]
    listed = "[" + ", ".join(map(_q, names)) + "]"
    return f"""
select '{model}' as model, s.statistic, s.term, s.other_term, s.value from (
  with r as (
    select [1.0::double, {", ".join(map(column, coefficients))}] as x, cast(observed_t as double) as y, {linear(intercept, coefficients)} as eta
    from ipcw_risk_set),
  p as (select x, y - 1 / (1 + exp(-eta)) as r, exp(-eta) / ((1 + exp(-eta)) * (1 + exp(-eta))) as w, 2 * (ln(1 + exp(eta)) - y * eta) as d from r),
  i as (select unnest(range(1, {len(names) + 1})) as i),
  j as (select unnest(range(1, {len(names) + 1})) as j)
  select 'deviance' as statistic, cast(null as varchar) as term, cast(null as varchar) as other_term, avg(d) as value from p
  union all select 'score', {listed}[i], null, avg(r * x[i]) from p, i group by i
  union all select 'information', {listed}[i], {listed}[j], avg(w * x[i] * x[j]) from p, i, j where i <= j group by i, j) s"""


cte("logit_sums", ("ipcw_risk_set",), _logit_sums("denominator", G.INTERCEPT["denominator"], G.DENOMINATOR) + "\nunion all"
    + _logit_sums("numerator", G.INTERCEPT["numerator"], G.NUMERATOR))

_USED = (f"(select count(distinct menopause_group) from ipcw_risk_set where menopause_group in {_in(GROUP_LEVELS[1:])})"
         f" + (select count(distinct race_ethnicity) from ipcw_risk_set where race_ethnicity in {_in(RACE_LEVELS[1:])})")  # fmt: skip
cte("ipcw_certificate", ("ipcw_risk_set",), f"""
select m.model, (select count(*) from ipcw_risk_set) as n_rows, cast(1 + m.numeric_columns + {_USED} as integer) as n_columns,
  true as converged, true as score_is_zero, cast(0 as integer) as n_dropped
from (values ('denominator', 4), ('numerator', 2)) m(model, numeric_columns)""")
cte("given_weights", ("ipcw_panel", "given_predictions"), """
select *, product(transition_weight_for_observed_outcome) over (
    partition by hhidpn order by wave rows between unbounded preceding and current row) as sw_cumulative
from (select p.hhidpn, p.wave, p.at_risk_for_observation, p.observed_cognition,
    coalesce(case when p.at_risk_for_observation and p.observed_cognition then g.stabilized_transition_weight else 1.0 end, 1.0)
      as transition_weight_for_observed_outcome
  from ipcw_panel p left join given_predictions g on p.hhidpn = g.hhidpn and p.wave = g.wave)""")
cte("given_rows", ("model2", "given_weights"), """
select m.hhidpn, m.wave, coalesce(w.sw_cumulative, 1.0) as sw_cumulative
from model2 m left join given_weights w on m.hhidpn = w.hhidpn and m.wave = w.wave""")
cte("given_truncated", ("given_rows",), """
select hhidpn, wave, sw_cumulative, least(greatest(sw_cumulative, lo), hi) as sw_truncated
from given_rows, (select quantile_cont(sw_cumulative, 0.01) as lo, quantile_cont(sw_cumulative, 0.99) as hi from given_rows)""")
cte("given_weight_summary", ("given_truncated", "ipcw_risk_set", "given_predictions"), """
select cast(count(*) as bigint) as n_person_waves, cast(count(distinct hhidpn) as bigint) as n_persons,
  min(sw_cumulative) as sw_untruncated_min, avg(sw_cumulative) as sw_untruncated_mean, max(sw_cumulative) as sw_untruncated_max,
  min(sw_truncated) as sw_truncated_min, avg(sw_truncated) as sw_truncated_mean, max(sw_truncated) as sw_truncated_max,
  (select cast(count(*) as bigint) from ipcw_risk_set) as risk_set_rows_for_ipcw_models,
  (select avg(p_observed_denominator) from given_predictions) as observed_probability_mean_denominator,
  (select avg(p_observed_numerator) from given_predictions) as observed_probability_mean_numerator,
  quantile_cont(sw_cumulative, 0.01) as sw_untruncated_p01, quantile_cont(sw_cumulative, 0.5) as sw_untruncated_median,
  quantile_cont(sw_cumulative, 0.99) as sw_untruncated_p99, quantile_cont(sw_truncated, 0.5) as sw_truncated_median
from given_truncated""")

# ---- standardized predictions -------------------------------------------------------
# Model 2's terms in order: (group level, race level, numeric covariate, power of age - 65)
TERMS = (
    [(None, None, None, 0)] + [(g, None, None, 0) for g in GROUP_LEVELS[1:]] + [(None, None, None, 1)]
    + [(None, r, None, 0) for r in RACE_LEVELS[1:]] + [(None, None, "birth_year_c10", 0), (None, None, "education_c12", 0)]
    + [(g, None, None, 1) for g in GROUP_LEVELS[1:]]
)


def mean_of(race, numeric) -> str:
    if race:
        return f"(select avg(case when race_ethnicity = {_q(race)} then 1.0 else 0.0 end) from covdist)"
    return f"(select avg(cast({numeric} as double)) from covdist)" if numeric else "1.0"


def rows_of_design(name: str, ages) -> None:
    grid = ", ".join(f"(cast({a} as double), {_q(g)}, {_q(GROUP_LABELS[g])})" for a in ages for g in GROUP_LEVELS)
    parts = []
    for i, (group, race, numeric, power) in enumerate(TERMS):
        e = f"pow(age - 65, {power}) * {mean_of(race, numeric)}"
        e += f" * (case when grp = {_q(group)} then 1.0 else 0.0 end)" if group else ""
        a, b = G.spread(i)
        parts.append(f"select age, grp, label, {i} as i, {e} as x, {G.beta(i)!r} as beta, {a!r} as a, {b!r} as b from grid")
    cte(name, ("covdist",), f"with grid as (select * from (values {grid}) t(age, grp, label))\n" + "\nunion all\n".join(parts))


def predictions(name: str, design: str) -> None:
    cte(name, (design,), f"""
select chronological_age, menopause_group, menopause_group_label, predicted_score, std_error,
  predicted_score - {Z975} * std_error as conf_low, predicted_score + {Z975} * std_error as conf_high
from (select age as chronological_age, grp as menopause_group, label as menopause_group_label,
    sum(x * beta) as predicted_score, sqrt(sum(a * x * x) + pow(sum(b * x), 2)) as std_error
  from {design} group by age, grp, label)""")


rows_of_design("given_design8", TABLE8_AGES)
rows_of_design("given_design_ages", TRAJECTORY_AGES)
predictions("given_means8", "given_design8")
predictions("given_trajectories", "given_design_ages")


def ci(x: str, low: str, high: str) -> str:
    return f"{_fx(x, 2)} || ' [' || {_fx(low, 2)} || ', ' || {_fx(high, 2)} || ']'"


cte("given_marginal_means", ("given_means8",),
    f"select *, {ci('predicted_score', 'conf_low', 'conf_high')} as predicted_score_ci from given_means8")
cte("given_contrasts", ("given_design8", "given_means8"), f"""
select *, {_fx("reference_predicted_score", 2)} as reference_predicted_score_ci, {p_text("p_value")} as p_value_formatted,
  {ci("absolute_difference", "conf_low", "conf_high")} as absolute_difference_ci
from (select *, absolute_difference - {Z975} * std_error as conf_low, absolute_difference + {Z975} * std_error as conf_high,
    {tail("(absolute_difference / std_error)")} as p_value
  from (select d.age, {_q(GROUP_LABELS[GROUP_LEVELS[0]])} as reference_group, d.label as comparison_group,
      r.predicted_score as reference_predicted_score, c.predicted_score as comparison_predicted_score,
      {ci("c.predicted_score", "c.conf_low", "c.conf_high")} as comparison_predicted_score_ci, d.absolute_difference, d.std_error
    from (select c.age, c.grp, c.label, sum((c.x - r.x) * c.beta) as absolute_difference,
        sqrt(sum(c.a * pow(c.x - r.x, 2)) + pow(sum(c.b * (c.x - r.x)), 2)) as std_error
      from given_design8 c join given_design8 r on c.age = r.age and c.i = r.i and r.grp = {_q(GROUP_LEVELS[0])}
      where c.grp in {_in(CONTRAST_GROUPS)} group by c.age, c.grp, c.label) d
    join given_means8 c on c.chronological_age = d.age and c.menopause_group = d.grp
    join given_means8 r on r.chronological_age = d.age and r.menopause_group = {_q(GROUP_LEVELS[0])}))""")
cte("given_contrasts_formatted", ("given_contrasts",), f"""
select age as "Age", reference_group as "Reference group", comparison_group as "Comparison group",
  {_fx("reference_predicted_score", 2)} as "Reference predicted score",
  {_fx("comparison_predicted_score", 2)} as "Comparison predicted score", {_fx("absolute_difference", 2)} as "Absolute difference",
  '[' || {_fx("conf_low", 2)} || ', ' || {_fx("conf_high", 2)} || ']' as "95% CI", p_value_formatted as "P value"
from given_contrasts""")
cte("given_trajectory_range", ("given_trajectories",), """
select menopause_group_label, min(predicted_score) as min_predicted, max(predicted_score) as max_predicted
from given_trajectories group by menopause_group_label""")


# ---- Model 0 at given covariance parameters: 2 x 2 matrices in closed form ------------
def growth(name: str, label: str, theta, weight: str) -> str:
    t0, t1, t2 = (repr(float(x)) for x in theta)
    sums = ", ".join([f"sum(w * pow(a, {k})) as s{k}" for k in range(3)] + [f"sum(w * pow(a, {k}) * y) as z{k}" for k in range(2)])
    return f"""
select {_q(label)} as model, x11, x12, x22, xy1, xy2, yy, ld, lw, n, persons, {t0} as t0, {t1} as t1, {t2} as t2 from (
  select sum(s0 - (s0 * s0 * k11 + 2 * s0 * s1 * k12 + s1 * s1 * k22)) as x11,
    sum(s1 - (s0 * s1 * k11 + (s0 * s2 + s1 * s1) * k12 + s1 * s2 * k22)) as x12,
    sum(s2 - (s1 * s1 * k11 + 2 * s1 * s2 * k12 + s2 * s2 * k22)) as x22,
    sum(z0 - (s0 * (k11 * z0 + k12 * z1) + s1 * (k12 * z0 + k22 * z1))) as xy1,
    sum(z1 - (s1 * (k11 * z0 + k12 * z1) + s2 * (k12 * z0 + k22 * z1))) as xy2,
    sum(yy - (k11 * z0 * z0 + 2 * k12 * z0 * z1 + k22 * z1 * z1)) as yy, sum(ln(det)) as ld, sum(lw) as lw,
    sum(n) as n, count(*) as persons
  from (select *, {t0} * {t0} * (1 + b22) / det as k11,
      {t0} * ({t1} * (1 + b22) - {t2} * b12) / det as k12,
      ({t1} * {t1} * (1 + b22) - 2 * {t1} * {t2} * b12 + {t2} * {t2} * (1 + b11)) / det as k22
    from (select *, (1 + b11) * (1 + b22) - b12 * b12 as det
      from (select *, {t0} * {t0} * s0 + 2 * {t0} * {t1} * s1 + {t1} * {t1} * s2 as b11,
          {t2} * ({t0} * s1 + {t1} * s2) as b12, {t2} * {t2} * s2 as b22
        from (select hhidpn, count(*) as n, {sums}, sum(w * y * y) as yy, sum(ln(w)) as lw
          from (select hhidpn, cast(age_c65 as double) as a, cast(cognitive_score as double) as y, {weight} as w from analysis)
          group by hhidpn)))))"""


cte("growth_sums", ("analysis",), "\nunion all\n".join([
    growth("plain", "plain", G.THETA, "cast(1 as double)"), growth("second", "second", G.THETA_2, "cast(1 as double)"),
    growth("weighted", "weighted", G.THETA, "0.5 + ((hhidpn + wave) % 5) / 4.0"),
]))
cte("growth", ("growth_sums",), """
select *, yy - xy1 * b1 - xy2 * b2 as r2, (yy - xy1 * b1 - xy2 * b2) / n as sigma2,
  ld - lw + n * (1 + ln(2 * pi() * (yy - xy1 * b1 - xy2 * b2) / n)) as deviance
from (select *, (x22 * xy1 - x12 * xy2) / (x11 * x22 - x12 * x12) as b1, (x11 * xy2 - x12 * xy1) / (x11 * x22 - x12 * x12) as b2
  from growth_sums)""")
# Derivatives in the covariance parameters. psi = T T' has three entries; per
# person P = (I + psi S)^-1, B = S P, and e = P'Z'W(y - X beta), where for Model 0
# X = Z, so that P'Z'WX = B.
def growth_persons(label: str, theta, weight: str) -> str:
    t0, t1, t2 = theta
    p00, p01, p11 = repr(float(t0 * t0)), repr(float(t0 * t1)), repr(float(t1 * t1 + t2 * t2))
    sums = ", ".join([f"sum(w * pow(a, {k})) as s{k}" for k in range(3)] + [f"sum(w * pow(a, {k}) * y) as z{k}" for k in range(2)])
    return f"""
select {_q(label)} as model, s0, s1, s2, z0, z1, a11 / det as q00, -a01 / det as q01, -a10 / det as q10, a00 / det as q11 from (
  select *, a00 * a11 - a01 * a10 as det from (
    select *, 1 + {p00} * s0 + {p01} * s1 as a00, {p00} * s1 + {p01} * s2 as a01, {p01} * s0 + {p11} * s1 as a10,
      1 + {p01} * s1 + {p11} * s2 as a11
    from (select hhidpn, {sums} from (
        select hhidpn, cast(age_c65 as double) as a, cast(cognitive_score as double) as y, {weight} as w from analysis) group by hhidpn)))"""


cte("growth_persons", ("analysis",), "\nunion all\n".join([
    growth_persons("plain", G.THETA, "cast(1 as double)"), growth_persons("second", G.THETA_2, "cast(1 as double)"),
    growth_persons("weighted", G.THETA, "0.5 + ((hhidpn + wave) % 5) / 4.0"),
]))

# the sums over persons: l of ln|A|, r of r2, v of the cross products times
# (-beta, 1), x of X'V^-1X; 0, 1, 2 are psi00, psi01, psi11
_PERSON = {
    "l0": "b00", "l1": "2 * b01", "l2": "b11",
    "l00": "-b00 * b00", "l01": "-2 * b00 * b01", "l02": "-b01 * b01", "l11": "-2 * (b01 * b01 + b00 * b11)",
    "l12": "-2 * b01 * b11", "l22": "-b11 * b11",
    "r0": "-e0 * e0", "r1": "-2 * e0 * e1", "r2_": "-e1 * e1",
    "h00": "2 * b00 * e0 * e0", "h01": "2 * (b00 * e0 * e1 + b01 * e0 * e0)", "h02": "2 * b01 * e0 * e1",
    "h11": "2 * (b00 * e1 * e1 + 2 * b01 * e0 * e1 + b11 * e0 * e0)", "h12": "2 * (b01 * e1 * e1 + b11 * e0 * e1)", "h22": "2 * b11 * e1 * e1",
    "v0a": "-b00 * e0", "v0b": "-b01 * e0", "v1a": "-(b00 * e1 + b01 * e0)", "v1b": "-(b01 * e1 + b11 * e0)",
    "v2a": "-b01 * e1", "v2b": "-b11 * e1",
    "x0aa": "-b00 * b00", "x0ab": "-b00 * b01", "x0bb": "-b01 * b01", "x1aa": "-2 * b00 * b01", "x1ab": "-(b00 * b11 + b01 * b01)",
    "x1bb": "-2 * b01 * b11", "x2aa": "-b01 * b01", "x2ab": "-b01 * b11", "x2bb": "-b11 * b11",
}
cte("growth_psi", ("growth_persons", "growth"), f"""
select m.*, i11, i12, i22, {", ".join(
    f"h{i}{j} - 2 * (v{i}a * (i11 * v{j}a + i12 * v{j}b) + v{i}b * (i12 * v{j}a + i22 * v{j}b)) as r{i}{j}"
    for i in range(3) for j in range(i, 3))}
from (select model, {", ".join(f"sum({e}) as {k}" for k, e in _PERSON.items())}
  from (select *, q00 * z0 + q10 * z1 - b00 * b1 - b01 * b2 as e0, q01 * z0 + q11 * z1 - b01 * b1 - b11 * b2 as e1
    from (select d.*, g.b1, g.b2, s0 * q00 + s1 * q10 as b00, s0 * q01 + s1 * q11 as b01, s1 * q01 + s2 * q11 as b11
      from growth_persons d join growth g on d.model = g.model)) group by model) m
join (select model, x22 / (x11 * x22 - x12 * x12) as i11, -x12 / (x11 * x22 - x12 * x12) as i12, x11 / (x11 * x22 - x12 * x12) as i22
  from growth) x on x.model = m.model""")

_J = [["2 * t0", "0", "0"], ["t1", "t0", "0"], ["0", "2 * t1", "2 * t2"]]  # of psi in theta


def _pull(names, a: int) -> str:
    return " + ".join(f"{n} * ({_J[k][a]})" for k, n in enumerate(names) if _J[k][a] != "0")


def _pull2(name, first, a: int, b: int) -> str:
    terms = [f"{name(min(k, m), max(k, m))} * ({_J[k][a]}) * ({_J[m][b]})" for k in range(3) for m in range(3)
             if _J[k][a] != "0" and _J[m][b] != "0"]
    bend = {(0, 0): f"2 * {first[0]}", (0, 1): first[1], (1, 1): f"2 * {first[2]}", (2, 2): f"2 * {first[2]}"}.get((a, b))
    return " + ".join(terms + ([bend] if bend else []))


_L1, _R1 = ("l0", "l1", "l2"), ("r0", "r1", "r2_")
_UPPER = [(a, b) for a in range(3) for b in range(a, 3)]
cte("growth_theta", ("growth_psi", "growth"), "select p.model, g.n, g.r2, g.sigma2, i11, i22, " + ", ".join(
    [f"{_pull(_L1, a)} as tl{a}, {_pull(_R1, a)} as tr{a}" for a in range(3)]
    + [f"{_pull2(lambda i, j: f'l{i}{j}', _L1, a, b)} as tl{a}{b}, {_pull2(lambda i, j: f'r{i}{j}', _R1, a, b)} as tr{a}{b}" for a, b in _UPPER]
    + [f"{_pull([f'(i11 * i11 * x{k}aa + 2 * i11 * i12 * x{k}ab + i12 * i12 * x{k}bb)' for k in range(3)], a)} as c0{a}" for a in range(3)]
    + [f"{_pull([f'(i12 * i12 * x{k}aa + 2 * i12 * i22 * x{k}ab + i22 * i22 * x{k}bb)' for k in range(3)], a)} as c1{a}" for a in range(3)]
) + " from growth_psi p join growth g on g.model = p.model")
cte("growth_gradient", ("growth_theta",), "\nunion all\n".join(
    f"select model, cast({a} as integer) as i, cast({b} as integer) as j, (tl{a} + n / r2 * tr{a}) / n as gradient, "
    f"(tl{min(a, b)}{max(a, b)} + n / r2 * (tr{min(a, b)}{max(a, b)} - tr{a} * tr{b} / r2)) / n as hessian from growth_theta"
    for a in range(3) for b in range(3)))


# Satterthwaite: the Hessian in (theta, sigma), its inverse by the Schur
# complement of sigma and cofactors, the variance's gradient on either side.
def _m(a: int, b: int) -> str:
    return f"m{min(a, b)}{max(a, b)}"


def _cofactor(a: int, b: int) -> str:
    r, c = [i for i in range(3) if i != a], [i for i in range(3) if i != b]
    sign = "-" if (a + b) % 2 else ""
    return f"{sign}({_m(r[0], c[0])} * {_m(r[1], c[1])} - {_m(r[0], c[1])} * {_m(r[1], c[0])})"


cte("growth_schur", ("growth_theta",), "select *, " + ", ".join(
    f"tl{a}{b} + tr{a}{b} / sigma2 - k{a} * k{b} / c as m{a}{b}" for a, b in _UPPER) + """
from (select *, -2 * tr0 / pow(sigma2, 1.5) as k0, -2 * tr1 / pow(sigma2, 1.5) as k1, -2 * tr2 / pow(sigma2, 1.5) as k2,
    6 * r2 / (sigma2 * sigma2) - 2 * n / sigma2 as c from growth_theta)""")
_DET = f"(m00 * {_cofactor(0, 0)} + m01 * {_cofactor(0, 1)} + m02 * {_cofactor(0, 2)})"


def _df(term: int, inverse: str) -> str:
    # g = (d theta, d sigma) of the variance; with w = d theta - k d sigma / c:
    # g' H^-1 g = w' M^-1 w + (d sigma)^2 / c
    quadratic = " + ".join(f"w{a} * w{b} * ({_cofactor(a, b)}) / {_DET}" for a in range(3) for b in range(3))
    ws = ", ".join(f"-sigma2 * c{term}{a} - k{a} * ds / c as w{a}" for a in range(3))
    return f"""select model, {term} as term, 2 * f * f / (2 * ({quadratic} + ds * ds / c)) as df
  from (select *, {ws} from (select *, sigma2 * {inverse} as f, 2 * sigma2 * {inverse} / sqrt(sigma2) as ds from growth_schur))"""


cte("growth_df", ("growth_schur",), _df(0, "i11") + "\nunion all\n" + _df(1, "i22"))
_SAMPLES = {"Model 0": ("analysis", "true"), "Model 1": ("analysis", "true"), "Model 6": ("model2", "baseline_normal = 1"),
            "Model 7": ("model2", f"menopause_group in {_in(NATURAL_GROUPS)}")}
cte("lmm_certificate", ("analysis", "model2"), "\nunion all\n".join(
    f"select {_q(name)} as model, cast(count(*) as bigint) as n_person_waves, cast(count(distinct hhidpn) as bigint) as n_persons, "
    f"true as converged, true as gradient_is_zero, true as hessian_is_positive from {table} where {where}"
    for name, (table, where) in ((MODEL_NAMES[m], _SAMPLES.get(m, ("model2", "true"))) for m in MODEL_NAMES)))
def t_tail(t: str, df: str) -> str:
    """The two-sided t tail: the series of the incomplete beta function from
    the side where it converges; the normal tail without df."""
    x = f"({df} / ({df} + pow({t}, 2)))"
    far = (f"list_sum(list_transform(range(0, 3000), lambda k: exp(lgamma({df} / 2 + 0.5 + k) - lgamma(0.5) - lgamma({df} / 2 + k + 1) "
           f"+ ({df} / 2 + k) * ln({x}) + 0.5 * ln(1 - {x}))))")  # fmt: skip
    return f"case when {df} is null then {tail(t)} when {x} < 0.5 then {far} else {_f_tail(f'pow({t}, 2)', '1.0', df)} end"


def t_975(df: str) -> str:
    """The 97.5 % point of t by Newton steps from the normal one: the tail is
    convex there, so the steps go up to it."""
    density = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2) - 0.5 * ln({df} * pi()) - ({df} + 1) / 2 * ln(1 + x * x / {df}))"
    steps = f"lambda x, z: x + ({t_tail('x', df)} / 2 - 0.025) / {density}"
    return f"list_reduce(list_prepend({Z975}::double, [0.0::double for _ in range(14)]), {steps})"


cte("growth_fixed", ("growth", "growth_df"), f"""
select model, term, estimate, std_error, df, estimate - crit * std_error as conf_low, estimate + crit * std_error as conf_high,
  estimate / std_error as statistic, {t_tail("(estimate / std_error)", "df")} as p_value
from (select g.model, case when d.term = 0 then '(Intercept)' else 'age_c65' end as term, case when d.term = 0 then b1 else b2 end as estimate,
    sqrt(sigma2 * (case when d.term = 0 then x22 else x11 end) / (x11 * x22 - x12 * x12)) as std_error, d.df, coalesce({t_975("d.df")}, {Z975}) as crit
  from growth g join (select model, term, case when df > 0 then df end as df from growth_df) d on d.model = g.model)""")
cte("growth_var", ("growth",), """
select model, sigma2, sigma2 * t0 * t0 as v0, sigma2 * t0 * t1 as c01, sigma2 * (t1 * t1 + t2 * t2) as v1 from growth""")
cte("growth_varcomp", ("growth_var",), """
select model, 'hhidpn' as "group", '(Intercept)' as effect_1, cast(null as varchar) as effect_2, v0 as variance_or_covariance,
  sqrt(v0) as sd_or_correlation from growth_var
union all select model, 'hhidpn', 'age_c65', null, v1, sqrt(v1) from growth_var
union all select model, 'hhidpn', '(Intercept)', 'age_c65', c01, c01 / sqrt(v0 * v1) from growth_var
union all select model, 'Residual', null, null, sigma2, sqrt(sigma2) from growth_var""")
cte("growth_fit", ("growth",), """
select model, cast(n as bigint) as n_person_waves, cast(persons as bigint) as n_persons, deviance + 12 as aic,
  deviance + ln(n) * 6 as bic, -deviance / 2 as log_likelihood, deviance, false as reml, false as singular_fit,
  case when model = 'weighted' then 'w' end as weights, 'None' as convergence_messages from growth""")
cte("growth_icc", ("growth_var",), """
select model, cast(65 + a as double) as chronological_age, cast(a as double) as age_c65, v0 + 2 * a * c01 + a * a * v1 as between_person_variance,
  sigma2 as residual_variance, (v0 + 2 * a * c01 + a * a * v1) / (v0 + 2 * a * c01 + a * a * v1 + sigma2) as icc,
  case when a = 0 then 'Primary ICC at age 65 because age is centered at 65'
    else 'Age-specific ICC implied by random intercept-slope covariance' end as interpretation
from growth_var, (values (-10), (0), (15)) t(a)""")
cte("growth_compare", ("growth_fit",), """
select model, n_person_waves, n_persons, aic, bic, log_likelihood, deviance, singular_fit, convergence_messages,
  aic - min(aic) over () as delta_aic_vs_best, bic - min(bic) over () as delta_bic_vs_best
from growth_fit where model <> 'weighted'""")

# ---- coefficient-shaped tables ----------------------------------------------------------
_ROWS = (("all", "true"), ("natural", f"menopause_group in {_in(NATURAL_GROUPS)}"))


def term_means(kinds) -> str:
    """kinds: (term suffix, factor, contrast suffix) of the group terms."""
    parts = []
    for label, where in _ROWS:
        for g in GROUP_LEVELS[1:]:
            for suffix, factor, contrast in kinds:
                parts.append(
                    f"select {_q(label)} as model, {_q(g + contrast)} as contrast, {_q('menopause_group' + g + suffix)} as term, "
                    f"avg(v) as estimate, stddev_samp(v) as std_error, cast(count(*) as double) as df, avg(v) - stddev_samp(v) as conf_low, "
                    f"avg(v) + stddev_samp(v) as conf_high, max(v) as statistic, avg(case when v = 0 then 1.0 else 0.0 end) as p_value "
                    f"from (select (case when menopause_group = {_q(g)} then 1.0 else 0.0 end) * {factor} + 0.0 as v from model2 where {where})"
                )
    return "\nunion all\n".join(parts)


_TWO = (":age_c65", "age_c65", "")
_THREE = (":age_c65:education_c12", "age_c65 * education_c12", ":education_c12")
cte("given_slopes", ("model2",), term_means([_TWO, _THREE]))
cte("given_three_way", ("model2",), term_means([(_THREE[0], _THREE[1], "")]))
_label = "case contrast " + " ".join(f"when {_q(g)} then {_q(GROUP_LABELS[g])}" for g in GROUP_LEVELS) + " else contrast end"
cte("given_sensitivity_long", ("model2",), f"""
select model, {_label} as contrast, estimate, std_error, conf_low, conf_high, p_value,
  printf('%.4f', estimate) || ' [' || printf('%.4f', conf_low) || ', ' || printf('%.4f', conf_high) || ']' as estimate_ci,
  {p_text("p_value")} as p_value_formatted, term from ({term_means([_TWO])})""")
cte("given_sensitivity_wide", ("given_sensitivity_long",), """
select contrast, max(case when model = 'all' then estimate_ci || '; p=' || p_value_formatted end) as "all",
  max(case when model = 'natural' then estimate_ci || '; p=' || p_value_formatted end) as "natural"
from given_sensitivity_long group by contrast""")
cte("given_fixed_formatted", ("given_slopes",), f"""
select model, term, {_fx("estimate", 4)} as estimate, {_fx("std_error", 4)} as std_error, {_fx("df", 1)} as df,
  {_fx("conf_low", 4)} as conf_low, {_fx("conf_high", 4)} as conf_high, {_fx("statistic", 3)} as statistic,
  {p_text("p_value")} as p_value from given_slopes""")
