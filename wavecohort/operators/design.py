"""Fixed-effect design columns with treatment contrasts (M1).

A model is a list of terms in R's order (main effects in formula order,
then two-way, then three-way interactions). Each design column is a
person-level coefficient times a power of the time variable:

    x_ij = c_j(person) * a_ij ** k_j

which holds because group, race, birth year and education are constant
within a person after invariant resolution. That factorization lets a
model be fitted from per-person moments of (1, a, a^2) alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import GROUP_LEVELS, NATURAL_LEVELS, RACE_LEVELS

# time-varying variables and the power of age_c65 they stand for
POWERS = {"age_c65": 1, "age_c65_sq": 2}
# person-constant categorical variables (reference level first)
FACTORS = {"menopause_group": GROUP_LEVELS, "race_ethnicity": RACE_LEVELS}
PERSON_COLUMNS = ("menopause_group", "race_ethnicity", "birth_year_c10", "education_c12")


@dataclass(frozen=True)
class Column_:
    name: str
    power: int
    factors: tuple  # ((variable, level) or (variable, None) for numeric)


@dataclass
class Design:
    columns: list[Column_]
    dropped: list[str] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def p(self) -> int:
        return len(self.columns)


def expand(terms: Sequence[Sequence[str]], levels: dict | None = None) -> Design:
    """Design columns of a term list; ``levels`` overrides factor levels
    (e.g. only the levels present, or the natural groups of Model 7)."""
    levels = {**FACTORS, **(levels or {})}
    cols = [Column_("(Intercept)", 0, ())]
    for term in terms:
        power = sum(POWERS.get(v, 0) for v in term)
        for names, facs in _r_order(term, levels):
            cols.append(Column_(":".join(names), power, tuple(facs)))
    return Design(cols)


def _r_order(term, levels):
    """Columns of one term; earlier variables vary fastest, as in R."""
    out = [([], [])]
    for v in term:
        if v in POWERS:
            opts = [(v, None)]
        elif v in levels:
            opts = [(v + lv, (v, lv)) for lv in levels[v][1:]]
        else:
            opts = [(v, (v, None))]
        out = [(n + [a], f + ([b] if b else [])) for a, b in opts for n, f in out]
    return out


def drop_unused(design: Design, used: dict) -> Design:
    """Drop columns of factor levels with no rows (R's model matrix keeps
    them as zero columns and lme4 drops them as rank deficient)."""
    keep, dropped = [], []
    for c in design.columns:
        ok = all(lv is None or lv in used.get(v, ()) for v, lv in c.factors)
        (keep if ok else dropped).append(c)
    return Design(keep, [c.name for c in dropped])


def used_levels(df: DataFrame, factors: dict | None = None) -> dict:
    """PF7: the declared levels that occur, all factors in one aggregate of
    one flag per level."""
    factors = FACTORS if factors is None else factors
    if not factors:
        return {}
    flags = {(v, lv): f"_{i}_{j}" for i, v in enumerate(factors) for j, lv in enumerate(factors[v])}
    row = df.agg(*[F.bool_or(F.col(v) == lv).alias(name) for (v, lv), name in flags.items()]).first()
    return {v: {lv for lv in factors[v] if row[flags[v, lv]]} for v in factors}


def coefficient(df_cols: dict, col: Column_):
    """numpy: person coefficient c_j from arrays of person covariates."""
    import numpy as np

    n = len(next(iter(df_cols.values())))
    c = np.ones(n)
    for v, lv in col.factors:
        if lv is None:
            c = c * df_cols[v].astype(float)
        else:
            c = c * (df_cols[v] == lv).astype(float)
    return c


def design_rows(df: DataFrame, design: Design, time: str = "age_c65") -> DataFrame:
    """Row-level design values in long form (id, wave, term_index, term,
    value): the model matrix without forming a wide frame."""
    exprs = []
    for j, c in enumerate(design.columns):
        e = F.pow(F.col(time), F.lit(c.power)) if c.power else F.lit(1.0)
        for v, lv in c.factors:
            e = e * (F.col(v).cast("double") if lv is None else (F.col(v) == lv).cast("double"))
        exprs.append(F.struct(F.lit(j).alias("term_index"), F.lit(c.name).alias("term"), (e.cast("double") + F.lit(0.0)).alias("value")))
    return df.select("hhidpn", "wave", F.inline(F.array(*exprs)))


# Fixed term lists of the analysis (R term order).
MODEL_TERMS = {
    "Model 0": [("age_c65",)],
    "Model 1": [("menopause_group",), ("age_c65",), ("menopause_group", "age_c65")],
    "Model 2": [("menopause_group",), ("age_c65",), ("race_ethnicity",), ("birth_year_c10",), ("education_c12",),
                ("menopause_group", "age_c65")],
    "Model 3": [("menopause_group",), ("age_c65",), ("education_c12",), ("race_ethnicity",), ("birth_year_c10",),
                ("menopause_group", "age_c65"), ("menopause_group", "education_c12"), ("age_c65", "education_c12"),
                ("menopause_group", "age_c65", "education_c12")],
    "Model 5": [("menopause_group",), ("age_c65",), ("age_c65_sq",), ("race_ethnicity",), ("birth_year_c10",),
                ("education_c12",), ("menopause_group", "age_c65"), ("menopause_group", "age_c65_sq")],
}
# products of person covariates, to check their joint averages
JOINT_TERMS = [("menopause_group",), ("age_c65",), ("race_ethnicity",), ("education_c12",), ("race_ethnicity", "education_c12"),
               ("menopause_group", "birth_year_c10", "education_c12")]
MODEL_TERMS["Model 4"] = MODEL_TERMS["Model 2"]
MODEL_TERMS["Model 6"] = MODEL_TERMS["Model 2"]
MODEL_TERMS["Model 7"] = MODEL_TERMS["Model 2"]
MODEL_LEVELS = {"Model 7": {"menopause_group": NATURAL_LEVELS}}
MODEL_NAMES = {
    "Model 0": "Model 0: unconditional growth",
    "Model 1": "Model 1: menopause group by age",
    "Model 2": "Model 2: exogenous-adjusted primary LMM",
    "Model 3": "Model 3: cognitive reserve interaction",
    "Model 4": "Model 4: IPCW-weighted adjusted LMM",
    "Model 5": "Model 5: quadratic age adjusted LMM",
    "Model 6": "Model 6: baseline-normal-only adjusted LMM",
    "Model 7": "Model 7: natural-menopause-only adjusted LMM",
}
PHASE5_NAMES = {"Model 2": "Model 2: primary unweighted adjusted LMM"}
