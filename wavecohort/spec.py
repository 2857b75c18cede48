"""Panel specification: column names, level lists and labels.

Every operator takes a ``PanelSpec`` instead of hard-coded names, so the
same code runs on any person-by-wave panel with the same meaning.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values that must equal the analysis being reproduced -------------
# Exposure groups with an established type/timing, in the reference order
# used for treatment contrasts (the first is the reference level).
VALID_GROUPS = (
    "1.Premature Natural",
    "2.Early Natural",
    "3.45-49 Natural",
    "4.50-55 Natural (ref)",
    "5.Late Natural",
    "6.Surgical",
)
NATURAL_GROUPS = (
    "1.Premature Natural",
    "2.Early Natural",
    "3.45-49 Natural",
    "4.50-55 Natural (ref)",
    "5.Late Natural",
)
GROUP_LEVELS = (
    "4.50-55 Natural (ref)",
    "1.Premature Natural",
    "2.Early Natural",
    "3.45-49 Natural",
    "5.Late Natural",
    "6.Surgical",
)
NATURAL_LEVELS = (
    "4.50-55 Natural (ref)",
    "1.Premature Natural",
    "2.Early Natural",
    "3.45-49 Natural",
    "5.Late Natural",
)
GROUP_LABELS = {
    "4.50-55 Natural (ref)": "Natural 50-55 (ref)",
    "1.Premature Natural": "Premature natural (<40)",
    "2.Early Natural": "Early natural (40-44)",
    "3.45-49 Natural": "Natural 45-49",
    "5.Late Natural": "Late natural (>55)",
    "6.Surgical": "Surgical",
}
PREMENOPAUSAL = "7.Premenopausal"
UNKNOWN_TYPE = "8.Unknown type"
UNKNOWN_INCONSISTENT = "9.Unknown/Inconsistent"
RACE_LEVELS = (
    "Non-Hispanic White",
    "Non-Hispanic Black",
    "Hispanic",
    "Non-Hispanic Other",
    "Missing/Unknown",
)
EDUCATION_LEVELS = (
    "Less than high school",
    "GED",
    "High school graduate",
    "Some college",
    "College or above",
    "Missing",
)
STATUS_LEVELS = ("Normal", "CIND", "Dementia", "Missing")
CONTRAST_GROUPS = ("2.Early Natural", "5.Late Natural", "6.Surgical")
TABLE8_AGES = (65, 75, 85)
TRAJECTORY_AGES = tuple(range(50, 91))
ICC_AGES_C65 = (-10, -5, 0, 5, 10, 15)
TIME_INVARIANT_CANDIDATES = (
    "rabyear", "raracem", "rahispan", "raeduc", "raedyrs",
    "Race", "Edu2", "Edu3", "Female", "ragender",
)
CONTINUOUS_COVARIATES = (
    ("baseline_age", "Baseline age, years"),
    ("baseline_cognition", "Baseline cognitive score, 0-27"),
    ("birth_year", "Birth year"),
    ("education_years", "Education, years"),
)
CATEGORICAL_COVARIATES = (
    ("race_ethnicity", "Race/ethnicity"),
    ("education_category", "Education category"),
    ("birth_cohort_decade", "Birth cohort decade"),
    ("baseline_cognitive_status", "Baseline cognitive status"),
)
MISSING_LEVEL = "Missing"
# --- end of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class PanelSpec:
    """Column map of a person-by-wave panel.

    ``age_candidates`` / ``score_candidates`` list alternative source names;
    the first present one is renamed to ``age`` / ``score`` at load.
    """

    id: str = "hhidpn"
    wave: str = "wave"
    year: str = "year"
    age: str = "agey_e"
    score: str = "cogtot27_imp"
    cogfunction: str = "cogfunction"
    female: str = "Female"
    gender: str = "ragender"
    exposure: str = "meno_combo"
    exposure_type: str = "meno_type"
    exposure_age5: str = "meno_age5"
    status: str = "meno_status_time"
    exposure_age: str = "C253_age"
    exposure_inconsistency: str = "C253_major_inconsistency"
    age_candidates: tuple = ("agey_e", "age_wave", "agey_b")
    score_candidates: tuple = ("cogtot27_imp", "cog27")
    later_phase_columns: tuple = ("rabyear", "raedyrs", "raeduc", "raracem", "rahispan")
    invariant_candidates: tuple = TIME_INVARIANT_CANDIDATES
    valid_groups: tuple = VALID_GROUPS
    natural_groups: tuple = NATURAL_GROUPS
    group_levels: tuple = GROUP_LEVELS
    group_labels: dict = field(default_factory=lambda: dict(GROUP_LABELS))

    def required(self) -> list[str]:
        return [
            self.id, self.wave, self.year, self.age, self.score, self.cogfunction,
            self.female, self.gender, self.exposure, self.exposure_type,
            self.exposure_age5, self.status, self.exposure_age,
        ]


DEFAULT_SPEC = PanelSpec()
