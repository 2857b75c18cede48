"""DuckDB check SQL for the correctness gate.

Each result is an independent SQL statement over the ``orders`` view:
the fixture panel CTE plus the CTEs the result depends on. CTEs are
written once below with their dependencies; ``sql_for(name)`` emits
them in dependency order. This is test-side text, not an engine.
"""

from __future__ import annotations

from ..sources.fixture import PANEL_SQL
from ..spec import (
    EDUCATION_LEVELS,
    GROUP_LABELS,
    GROUP_LEVELS,
    NATURAL_GROUPS,
    RACE_LEVELS,
    STATUS_LEVELS,
    VALID_GROUPS,
)

INV_VARS = ("rabyear", "raracem", "rahispan", "raeduc", "raedyrs", "Female", "ragender")


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


cte("panel", (), PANEL_SQL)

# ---- phase 1 -------------------------------------------------------------
cte("first_assessment", ("panel",), """
select hhidpn, wave as first_cog_wave, year as first_cog_year, agey_e as first_cog_age, cogtot27_imp as first_cog_score
from (select *, row_number() over (partition by hhidpn order by agey_e, wave) as rn
      from panel where cogtot27_imp is not null and agey_e is not null) where rn = 1""")

cte("ea_mode", ("panel",), """
select hhidpn, v as menopause_age_resolved from (
  select hhidpn, v, row_number() over (partition by hhidpn order by n desc, f) as rn from (
    select hhidpn, "C253_age" as v, count(*) as n, min(wave) as f from panel
    where "C253_age" is not null group by hhidpn, "C253_age")) where rn = 1""")

cte("exposure_age", ("panel", "ea_mode"), """
select s.hhidpn, m.menopause_age_resolved, s.menopause_age_min, s.menopause_age_max,
       s.menopause_age_n_reports, s.menopause_age_n_distinct
from (select hhidpn, min("C253_age") as menopause_age_min, max("C253_age") as menopause_age_max,
             cast(count("C253_age") as bigint) as menopause_age_n_reports,
             cast(count(distinct "C253_age") as bigint) as menopause_age_n_distinct
      from panel group by hhidpn) s left join ea_mode m on s.hhidpn = m.hhidpn""")

cte("temporal_order", ("first_assessment", "exposure_age"), """
select f.*, e.menopause_age_resolved, e.menopause_age_min, e.menopause_age_max,
       e.menopause_age_n_reports, e.menopause_age_n_distinct,
       (e.menopause_age_resolved is not null and f.first_cog_age is not null
        and e.menopause_age_resolved > f.first_cog_age) as temporal_order_violation,
       (e.menopause_age_min is not null and e.menopause_age_max is not null and f.first_cog_age is not null
        and e.menopause_age_min <= f.first_cog_age and e.menopause_age_max > f.first_cog_age) as temporal_order_ambiguous
from first_assessment f left join exposure_age e on f.hhidpn = e.hhidpn""")

cte("temporal_order_summary", ("temporal_order",), """
select cast(count(*) as bigint) as persons_with_valid_cognition,
       cast(count(menopause_age_resolved) as bigint) as persons_with_reported_menopause_age,
       cast(count_if(temporal_order_violation) as bigint) as persons_temporal_order_violation,
       cast(count_if(temporal_order_ambiguous) as bigint) as persons_temporal_order_ambiguous
from temporal_order""")

cte("inv_long", ("panel",), "\nunion all\n".join(
    f"select hhidpn, wave, '{v}' as variable, cast(\"{v}\" as varchar) as value from panel" for v in INV_VARS))

cte("invariant_diag", ("inv_long",), """
select l.hhidpn, l.variable, cast(count(l.value) as bigint) as n_nonmissing,
       cast(count(distinct l.value) as bigint) as n_distinct_nonmissing,
       coalesce(any_value(o.observed_values), '') as observed_values,
       count(distinct l.value) > 1 as inconsistent
from inv_long l left join (
  select hhidpn, variable, string_agg(value, ' | ' order by f) as observed_values from (
    select hhidpn, variable, value, min(wave) as f from inv_long where value is not null group by hhidpn, variable, value)
  group by hhidpn, variable) o on l.hhidpn = o.hhidpn and l.variable = o.variable
group by l.hhidpn, l.variable""")

cte("invariant_summary", ("invariant_diag",), """
select variable, cast(count(*) as bigint) as persons_checked,
       cast(count_if(n_nonmissing = 0) as bigint) as persons_all_missing,
       cast(count_if(inconsistent) as bigint) as persons_inconsistent,
       count_if(inconsistent) / count(*) as pct_inconsistent,
       max(n_distinct_nonmissing) as max_distinct_values
from invariant_diag group by variable""")

cte("inv_mode", ("inv_long",), """
select hhidpn, variable, value from (
  select hhidpn, variable, value, row_number() over (partition by hhidpn, variable order by n desc, f) as rn from (
    select hhidpn, variable, value, count(*) as n, min(wave) as f from inv_long
    where value is not null group by hhidpn, variable, value)) where rn = 1""")

cte("invariant_modes", ("panel", "inv_mode"), """
select p.hhidpn, """ + ",\n  ".join(
    f"cast(max(case when m.variable = '{v}' then m.value end) as integer) as \"{v}\"" for v in INV_VARS) + """
from (select distinct hhidpn from panel) p left join inv_mode m on p.hhidpn = m.hhidpn group by p.hhidpn""")

cte("resolved", ("panel", "invariant_modes"), """
select p.* replace (""" + ", ".join(f'm."{v}" as "{v}"' for v in INV_VARS) + """)
from panel p join invariant_modes m on p.hhidpn = m.hhidpn""")

cte("transitions0", ("resolved",), """
select hhidpn, wave, meno_status_time, std as meno_status_standard,
       case when std = 'premenopausal' then 0 when std = 'postmenopausal' then 1 end as meno_status_rank
from (select *, case when contains(lower(meno_status_time), 'pre') then 'premenopausal'
                     when contains(lower(meno_status_time), 'post') then 'postmenopausal' end as std from resolved)""")

cte("transitions", ("transitions0",), """
select *, meno_status_rank = 0 and prior_post_observed = 1 as backward_meno_transition from (
  select *, coalesce(max(post_observed) over (partition by hhidpn order by wave
                     rows between unbounded preceding and 1 preceding), 0) as prior_post_observed
  from (select *, coalesce(cast(meno_status_rank = 1 as integer), 0) as post_observed from transitions0))""")

cte("transition_person", ("transitions",), """
select hhidpn, coalesce(bool_or(backward_meno_transition), false) as any_backward_meno_transition,
       min(case when backward_meno_transition then wave end) as first_backward_wave,
       string_agg(cast(wave as varchar) || ':' || coalesce(meno_status_standard, 'missing_or_unknown'), ' -> ' order by wave) as status_sequence
from transitions group by hhidpn""")

cte("transition_summary", ("transition_person",), """
select cast(count(*) as bigint) as persons_checked,
       cast(count_if(any_backward_meno_transition) as bigint) as persons_backward_meno_transition
from transition_person""")

cte("missing_panel", ("resolved",), """
select g.hhidpn, g.wave, coalesce(b.row_present, false) as row_present, b.year, b.age, b.cognition,
       coalesce(b.row_present, false) and b.cognition is not null as valid_cognition,
       case when coalesce(b.row_present, false) and b.cognition is not null then 'valid_cognition'
            when coalesce(b.row_present, false) and b.cognition is null then 'observed_row_missing_cognition'
            when not coalesce(b.row_present, false) then 'no_person_wave_row' else 'unclassified' end as missing_state
from (select s.hhidpn, w.wave from (select hhidpn, min(wave) as f from resolved group by hhidpn) s
      join (select distinct wave from resolved) w on w.wave >= s.f) g
left join (select hhidpn, wave, true as row_present, max(year) as year, max(agey_e) as age, max(cogtot27_imp) as cognition
           from resolved group by hhidpn, wave) b on g.hhidpn = b.hhidpn and g.wave = b.wave""")

cte("missingness_by_wave", ("missing_panel",), """
select wave, cast(count(*) as bigint) as persons_in_risk_set,
       cast(count_if(row_present) as bigint) as person_wave_rows_present,
       cast(count_if(valid_cognition) as bigint) as valid_cognition,
       cast(count_if(missing_state = 'observed_row_missing_cognition') as bigint) as observed_rows_missing_cognition,
       cast(count_if(missing_state = 'no_person_wave_row') as bigint) as no_person_wave_row,
       cast(count_if(missing_state = 'observed_row_missing_cognition') + count_if(missing_state = 'no_person_wave_row') as bigint) as total_missing_cognition_or_row,
       (count_if(missing_state = 'observed_row_missing_cognition') + count_if(missing_state = 'no_person_wave_row')) / count(*) as pct_missing_cognition_or_row
from missing_panel group by wave""")

cte("missingness_person", ("missing_panel",), """
select *, case when n_valid_cognition = 0 then 'zero_valid_cognitive_assessments'
  when n_observed_rows_missing_cognition = 0 and n_no_person_wave_row = 0 then 'complete_from_entry_to_last_wave'
  when any_missing_between_valid_cognition then 'intermittent_missingness'
  when any_missing_after_last_valid_cognition then 'monotone_missingness_attrition_compatible'
  when any_missing_before_first_valid_cognition then 'missing_before_first_valid_cognition_only'
  else 'other_missingness_pattern' end as missingness_class
from (select hhidpn, cast(count(*) as bigint) as n_panel_waves,
        cast(count_if(valid_cognition) as bigint) as n_valid_cognition,
        cast(count_if(missing_state = 'observed_row_missing_cognition') as bigint) as n_observed_rows_missing_cognition,
        cast(count_if(missing_state = 'no_person_wave_row') as bigint) as n_no_person_wave_row,
        min(f) as first_valid_cog_wave, max(l) as last_valid_cog_wave,
        coalesce(bool_or(not valid_cognition and wave > f and wave < l), false) as any_missing_between_valid_cognition,
        coalesce(bool_or(not valid_cognition and wave > l), false) as any_missing_after_last_valid_cognition,
        coalesce(bool_or(not valid_cognition and wave < f), false) as any_missing_before_first_valid_cognition,
        string_agg(ch, '' order by wave) as missingness_pattern
      from (select *, min(case when valid_cognition then wave end) over (partition by hhidpn) as f,
                      max(case when valid_cognition then wave end) over (partition by hhidpn) as l,
                      case when valid_cognition then 'O' when missing_state = 'observed_row_missing_cognition' then 'M'
                           when missing_state = 'no_person_wave_row' then 'N' else '?' end as ch
            from missing_panel) group by hhidpn)""")

cte("missingness_summary", ("missingness_person",), """
select missingness_class, n_persons, n_persons / sum(n_persons) over () as pct_persons
from (select missingness_class, cast(count(*) as bigint) as n_persons from missingness_person group by missingness_class)""")

cte("integrity_flags", ("resolved", "temporal_order", "transition_person"), """
select *, temporal_order_violation or any_backward_meno_transition as phase1_integrity_exclude,
  case when temporal_order_violation and any_backward_meno_transition then 'menopause_after_first_cognition_and_backward_transition'
       when temporal_order_violation then 'menopause_after_first_cognition'
       when any_backward_meno_transition then 'post_to_pre_menopause_backward_transition' end as phase1_integrity_exclusion_reason
from (select p.hhidpn, coalesce(t.temporal_order_violation, false) as temporal_order_violation,
        coalesce(t.temporal_order_ambiguous, false) as temporal_order_ambiguous, t.first_cog_age, t.menopause_age_resolved,
        coalesce(tp.any_backward_meno_transition, false) as any_backward_meno_transition, tp.first_backward_wave,
        coalesce(c.any_c253_major_inconsistency, false) as any_c253_major_inconsistency
      from (select distinct hhidpn from resolved) p
      left join temporal_order t on p.hhidpn = t.hhidpn
      left join transition_person tp on p.hhidpn = tp.hhidpn
      left join (select hhidpn, coalesce(bool_or("C253_major_inconsistency" = 1), false) as any_c253_major_inconsistency
                 from resolved group by hhidpn) c on p.hhidpn = c.hhidpn)""")

cte("integrity_cascade", ("integrity_flags",), """
select * from (
  select 0 as step_index, 'Raw person file' as step, cast(0 as bigint) as n_dropped, cast(count(*) as bigint) as n_remaining from integrity_flags
  union all
  select 1, 'Drop menopause-after-first-cognition temporal violations', cast(count_if(temporal_order_violation) as bigint),
         cast(count(*) - count_if(temporal_order_violation) as bigint) from integrity_flags
  union all
  select 2, 'Drop post-to-pre menopause backward transitions',
         cast(count_if(any_backward_meno_transition and not temporal_order_violation) as bigint),
         cast(count(*) - count_if(temporal_order_violation) - count_if(any_backward_meno_transition and not temporal_order_violation) as bigint)
  from integrity_flags)""")

cte("clean", ("resolved", "integrity_flags"), """
select r.*, f.phase1_integrity_exclusion_reason from resolved r join integrity_flags f on r.hhidpn = f.hhidpn
where not f.phase1_integrity_exclude""")

# ---- phase 2 -------------------------------------------------------------
cte("base", ("clean",), f"""
select *, is_female and age_eligible and valid_cognition and valid_menopause_exposure as eligible_timezero_wave
from (select *, case when "Female" is not null then "Female" = 1 when ragender is not null then ragender = 2 end as is_female,
        cogtot27_imp is not null as valid_cognition,
        agey_e is not null and agey_e >= 50 as age_eligible,
        coalesce(meno_combo in {_in(VALID_GROUPS)}, false) as valid_menopause_exposure,
        coalesce(meno_combo in {_in(NATURAL_GROUPS)}, false) as natural_menopause_group
      from clean)""")

cte("female_mode", ("base",), """
select hhidpn, v as person_female from (
  select hhidpn, v, row_number() over (partition by hhidpn order by n desc, f) as rn from (
    select hhidpn, is_female as v, count(*) as n, min(wave) as f from base where is_female is not null group by hhidpn, is_female))
where rn = 1""")

cte("cohort_flags", ("base", "female_mode"), """
select a.hhidpn, coalesce(m.person_female, false) as person_female, a.any_valid_menopause_exposure,
       a.any_valid_cognitive_assessment, a.n_valid_cognitive_assessments, a.any_eligible_timezero_wave
from (select hhidpn, coalesce(bool_or(valid_menopause_exposure), false) as any_valid_menopause_exposure,
        coalesce(bool_or(valid_cognition), false) as any_valid_cognitive_assessment,
        cast(count_if(valid_cognition) as bigint) as n_valid_cognitive_assessments,
        coalesce(bool_or(eligible_timezero_wave), false) as any_eligible_timezero_wave
      from base group by hhidpn) a left join female_mode m on a.hhidpn = m.hhidpn""")

cte("exposure_availability", ("base",), """
select *, case when any_valid_menopause_exposure then 'has_valid_exposure'
  when all_meno_combo_missing then 'all_menopause_combo_missing'
  when ever_premenopausal and not ever_unknown_type and not ever_unknown_inconsistent then 'only_premenopausal_or_missing'
  when ever_unknown_type or ever_unknown_inconsistent then 'unknown_or_inconsistent_only'
  else 'other_no_valid_exposure' end as exposure_problem_class
from (select hhidpn, coalesce(bool_or(valid_menopause_exposure), false) as any_valid_menopause_exposure,
        coalesce(bool_or(meno_combo = '7.Premenopausal'), false) as ever_premenopausal,
        coalesce(bool_or(meno_combo = '8.Unknown type'), false) as ever_unknown_type,
        coalesce(bool_or(meno_combo = '9.Unknown/Inconsistent'), false) as ever_unknown_inconsistent,
        coalesce(bool_and(meno_combo is null), true) as all_meno_combo_missing,
        array_to_string(list_sort(list_distinct(list(meno_combo))), ' | ') as observed_meno_combo_values
      from base group by hhidpn)""")

cte("baseline", ("base",), f"""
select hhidpn, wave as baseline_wave, year as baseline_year, agey_e as baseline_age, cogtot27_imp as baseline_cognition,
       cogfunction as baseline_cogfunction, cogfunction = 3 as baseline_dementia,
       cast(case when cogfunction = 1 then 1 when cogfunction = 2 then 0 when cogfunction = 3 then 0 end as integer) as baseline_normal,
       cogfunction = 2 as baseline_cind, meno_combo as menopause_group, meno_type as menopause_type,
       meno_age5 as menopause_age_category, "C253_age" as baseline_exposure_age,
       coalesce(meno_combo in {_in(NATURAL_GROUPS)}, false) as natural_menopause_group
from (select *, row_number() over (partition by hhidpn order by wave) as rn from base where eligible_timezero_wave) where rn = 1""")

cte("cohort_steps", ("cohort_flags", "baseline"), """
select f.hhidpn, case when not f.person_female then 0 when not f.any_valid_menopause_exposure then 1
  when not f.any_valid_cognitive_assessment then 2 when not f.any_eligible_timezero_wave then 3
  when coalesce(b.baseline_dementia, false) then 4 else 5 end as last_step_passed
from cohort_flags f left join baseline b on f.hhidpn = b.hhidpn""")

_steps = (
    "Start after Phase 1 integrity exclusions",
    "Drop men",
    "Drop women with missing/invalid menopause type-timing exposure",
    "Drop women with zero valid cognitive assessments",
    "Drop women with no eligible Time Zero wave",
    "Drop prevalent dementia at baseline",
)
_cascade_parts = []
for _s, _name in enumerate(_steps):
    before = "cast(null as bigint)" if _s == 0 else f"cast(count_if(last_step_passed >= {_s - 1}) as bigint)"
    dropped = "cast(0 as bigint)" if _s == 0 else f"cast(count_if(last_step_passed >= {_s - 1}) - count_if(last_step_passed >= {_s}) as bigint)"
    _cascade_parts.append(
        f"select {_s} as step_index, {_q(_name)} as step, {before} as n_persons_before, {dropped} as n_persons_dropped, "
        f"cast(count_if(last_step_passed >= {_s}) as bigint) as n_persons_remaining, "
        f"cast(coalesce(sum(case when last_step_passed >= {_s} then r end), 0) as bigint) as n_rows_remaining "
        f"from (select s.last_step_passed, r.r from cohort_steps s left join "
        f"(select hhidpn, count(*) as r from base group by hhidpn) r on s.hhidpn = r.hhidpn)"
    )
cte("exclusion_cascade", ("cohort_steps", "base"), "\nunion all\n".join(_cascade_parts))

cte("baseline_person", ("baseline", "cohort_steps"), """
select * from baseline where hhidpn in (select hhidpn from cohort_steps where last_step_passed = 5)""")

cte("baseline_groups", ("baseline_person",), """
select menopause_group, cast(count(*) as bigint) as n_persons from baseline_person group by menopause_group""")

cte("allwaves", ("base", "baseline_person"), """
select a.*, b.baseline_wave, b.baseline_year, b.baseline_age, b.baseline_cognition, b.baseline_cogfunction,
       b.baseline_normal, b.baseline_cind, b.menopause_group, b.menopause_type, b.menopause_age_category,
       b.baseline_exposure_age, b.natural_menopause_group as baseline_natural_group,
       a.wave - b.baseline_wave as time_since_baseline_wave, a.year - b.baseline_year as time_since_baseline_year,
       a.agey_e - 65 as age_centered_65, a.cogtot27_imp is not null as post_baseline_valid_cognition
from base a join baseline_person b on a.hhidpn = b.hhidpn where a.wave >= b.baseline_wave""")

cte("ready", ("allwaves",), "select * from allwaves where post_baseline_valid_cognition")

cte("cohort_summary", ("allwaves", "ready", "baseline_person"), """
select (select cast(count(distinct hhidpn) as bigint) from allwaves) as n_persons,
       (select cast(count(*) as bigint) from allwaves) as n_person_waves_all_post_timezero,
       (select cast(count(*) as bigint) from ready) as n_person_waves_valid_cognition,
       (select avg(n) from (select count(*) as n from ready group by hhidpn)) as mean_valid_cognitive_assessments_per_person,
       (select quantile_cont(n, 0.5) from (select count(*) as n from ready group by hhidpn)) as median_valid_cognitive_assessments_per_person,
       (select cast(count_if(baseline_normal = 1) as bigint) from baseline_person) as n_baseline_normal,
       (select cast(count_if(baseline_cind) as bigint) from baseline_person) as n_baseline_cind,
       (select cast(count_if(baseline_normal is null) as bigint) from baseline_person) as n_baseline_normal_missing""")


# ---- phase 3-7 inputs ---------------------------------------------------------
_label_case = "case menopause_group " + " ".join(f"when {_q(k)} then {_q(v)}" for k, v in GROUP_LABELS.items()) + " end"
cte("analysis_all", ("allwaves",), f"""
select * replace (case when menopause_group in {_in(GROUP_LEVELS)} then menopause_group end as menopause_group),
  cogtot27_imp as cognitive_score, agey_e as chronological_age, agey_e - 65 as age_c65, pow(agey_e - 65, 2) as age_c65_sq,
  {_label_case.replace('case menopause_group', 'case (case when menopause_group in ' + _in(GROUP_LEVELS) + ' then menopause_group end)')} as menopause_group_label,
  case when rahispan = 1 then 'Hispanic' when rahispan = 0 and raracem = 1 then 'Non-Hispanic White'
       when rahispan = 0 and raracem = 2 then 'Non-Hispanic Black' when rahispan = 0 and raracem = 3 then 'Non-Hispanic Other'
       else 'Missing/Unknown' end as race_ethnicity,
  cast(raedyrs as double) as education_years, cast(raedyrs - 12 as double) as education_c12,
  case when raeduc = 1 then 'Less than high school' when raeduc = 2 then 'GED' when raeduc = 3 then 'High school graduate'
       when raeduc = 4 then 'Some college' when raeduc = 5 then 'College or above' else 'Missing' end as education_category,
  cast(rabyear as double) as birth_year, (rabyear - 1940) / 10 as birth_year_c10,
  case when rabyear is null then 'Missing' else cast(cast(floor(rabyear / 10) * 10 as bigint) as varchar) || 's' end as birth_cohort_decade,
  case when baseline_cogfunction = 1 then 'Normal' when baseline_cogfunction = 2 then 'CIND'
       when baseline_cogfunction = 3 then 'Dementia' else 'Missing' end as baseline_cognitive_status,
  cogtot27_imp is not null as observed_cognition
from allwaves""")

cte("analysis", ("analysis_all",), """
select * from analysis_all where cognitive_score is not null and chronological_age is not null
  and age_c65 is not null and menopause_group is not null and post_baseline_valid_cognition""")

cte("model2", ("analysis",), """
select * from analysis where cognitive_score is not null and age_c65 is not null and menopause_group is not null
  and race_ethnicity is not null and birth_year_c10 is not null and education_c12 is not null""")

cte("baseline_analysis", ("analysis",), """
select * exclude (rn) from (select *, row_number() over (partition by hhidpn order by wave) as rn
  from analysis where wave = baseline_wave) where rn = 1""")

cte("trajectory_summary", ("analysis",), """
select menopause_group, menopause_group_label, cast(count(distinct hhidpn) as bigint) as n_persons,
  cast(count(*) as bigint) as n_person_waves, min(chronological_age) as min_age, max(chronological_age) as max_age
from analysis group by menopause_group, menopause_group_label""")

cte("rbase", ("model2",), """
select hhidpn, baseline_wave, menopause_group, menopause_group_label from (
  select *, row_number() over (partition by hhidpn order by wave) as rn from model2 where wave = baseline_wave) where rn = 1""")

cte("retention_panel", ("rbase", "allwaves"), """
select g.hhidpn, g.wave, b.baseline_wave, b.menopause_group, b.menopause_group_label,
  coalesce(o.row_present, false) as row_present, coalesce(o.observed_cognition, false) as observed_cognition,
  g.wave - b.baseline_wave as followup_wave
from (select b.hhidpn, w.wave from rbase b join (select distinct wave from allwaves) w on w.wave >= b.baseline_wave) g
left join rbase b on g.hhidpn = b.hhidpn
left join (select hhidpn, wave, true as row_present, coalesce(bool_or(cogtot27_imp is not null), false) as observed_cognition
           from allwaves where hhidpn in (select hhidpn from rbase) group by hhidpn, wave) o
  on g.hhidpn = o.hhidpn and g.wave = o.wave""")

cte("attrition_events", ("retention_panel",), """
select *, first_missing_followup is not null as attrition_event,
  cast(case when first_missing_followup is not null then first_missing_followup else max_followup_wave end as double) as time_to_attrition_or_censor
from (select hhidpn, menopause_group, menopause_group_label, baseline_wave,
        cast(min(case when followup_wave > 0 and not observed_cognition then followup_wave end) as double) as first_missing_followup,
        max(followup_wave) as max_followup_wave
      from retention_panel group by hhidpn, menopause_group, menopause_group_label, baseline_wave)""")

cte("km_curve", ("attrition_events",), """
select cast(0 as double) as followup_wave, cast(1 as double) as retention_probability, cast(0 as double) as std_error,
  cast(1 as double) as conf_low, cast(1 as double) as conf_high, cast(count(*) as bigint) as n_risk,
  cast(0 as bigint) as n_event, cast(0 as bigint) as n_censor, cast(0 as bigint) as n_censor_since_previous, menopause_group_label
from attrition_events group by menopause_group_label
union all
select t, s, case when s > 0 then s * sqrt(g) end,
  case when s > 0 then exp(ln(s) - 1.959963984540054 * sqrt(g)) end,
  case when s > 0 then least(1.0, exp(ln(s) + 1.959963984540054 * sqrt(g))) end,
  n, d, c, cast(cumc - coalesce(lag(cumc) over (partition by menopause_group_label order by t), 0) as bigint), menopause_group_label
from (select *, product(1 - d / n) over w as s, sum(case when n > d then d / (n * (n - d)) end) over w as g
      from (select *, cast(sum(m) over (partition by menopause_group_label order by t desc
                        rows between unbounded preceding and current row) as bigint) as n,
                      sum(c) over (partition by menopause_group_label order by t rows between unbounded preceding and current row) as cumc
            from (select menopause_group_label, time_to_attrition_or_censor as t,
                    cast(count_if(attrition_event) as bigint) as d, cast(count_if(not attrition_event) as bigint) as c,
                    cast(count(*) as bigint) as m
                  from attrition_events group by menopause_group_label, time_to_attrition_or_censor))
      where d > 0
      window w as (partition by menopause_group_label order by t rows between unbounded preceding and current row))""")

cte("retention_by_wave", ("retention_panel",), """
select menopause_group_label, followup_wave, cast(count(distinct hhidpn) as bigint) as n_baseline_group,
  cast(count_if(observed_cognition) as bigint) as n_observed_cognition,
  count_if(observed_cognition) / count(distinct hhidpn) as simple_retention_proportion
from retention_panel group by menopause_group_label, followup_wave""")

cte("attrition_share", ("attrition_events",), """
select *, n / sum(n) over (partition by menopause_group_label) as pct from (
  select menopause_group_label, attrition_event, cast(count(*) as bigint) as n from attrition_events
  group by menopause_group_label, attrition_event)""")

cte("ibase", ("model2",), """
select hhidpn, baseline_wave, menopause_group, race_ethnicity, birth_year_c10, education_c12, baseline_normal from (
  select *, row_number() over (partition by hhidpn order by wave) as rn from model2 where wave = baseline_wave) where rn = 1""")

cte("ipcw_panel", ("ibase", "analysis_all"), """
select *, wave > baseline_wave and lag_observed_cognition as at_risk_for_observation,
  cast(observed_cognition as integer) as observed_t
from (select *, lag(observed_cognition) over w as lag_observed_cognition, lag(cognitive_score) over w as lag_cognitive_score,
        lag(chronological_age) over w as lag_chronological_age
      from (select g.hhidpn, g.wave, b.baseline_wave, b.menopause_group, b.race_ethnicity, b.birth_year_c10, b.education_c12,
              b.baseline_normal, coalesce(o.row_present, false) as row_present, o.cognitive_score, o.chronological_age,
              coalesce(o.observed_cognition, false) as observed_cognition
            from (select b.hhidpn, w.wave from ibase b join (select distinct wave from analysis_all) w on w.wave >= b.baseline_wave) g
            left join ibase b on g.hhidpn = b.hhidpn
            left join (select hhidpn, wave, true as row_present, first(cognitive_score) as cognitive_score,
                         first(chronological_age) as chronological_age,
                         coalesce(bool_or(cognitive_score is not null), false) as observed_cognition
                       from analysis_all where hhidpn in (select hhidpn from ibase) group by hhidpn, wave) o
              on g.hhidpn = o.hhidpn and g.wave = o.wave)
      window w as (partition by hhidpn order by wave))""")

cte("ipcw_risk_set", ("ipcw_panel",), """
select * from ipcw_panel where at_risk_for_observation and observed_t is not null and menopause_group is not null
  and race_ethnicity is not null and birth_year_c10 is not null and education_c12 is not null
  and lag_cognitive_score is not null and lag_chronological_age is not null""")


# ---- balance ---------------------------------------------------------------------
_CONT = ("baseline_age", "baseline_cognition", "birth_year", "education_years")
_CAT = ("race_ethnicity", "education_category", "birth_cohort_decade", "baseline_cognitive_status")
_DECL = {"race_ethnicity": RACE_LEVELS, "education_category": EDUCATION_LEVELS, "baseline_cognitive_status": STATUS_LEVELS}
cte("sc_m", ("baseline_analysis",), "select variable, g, count(*) as n, avg(x) as mean, var_samp(x) as var, sum(x) as sx from (\n" + "\nunion all\n".join(
    f"select menopause_group as g, '{v}' as variable, cast({v} as double) as x from baseline_analysis" for v in _CONT)
    + ") where x is not null and g is not null group by variable, g")
cte("smd_continuous", ("sc_m",), "select v.variable, p.max_pairwise_smd from (values " + ", ".join(f"('{v}')" for v in _CONT) + """) v(variable)
left join (select a.variable, max(case when sqrt((a.var + b.var) / 2) is null or sqrt((a.var + b.var) / 2) = 0 then cast(0 as double)
                 else abs(a.mean - b.mean) / sqrt((a.var + b.var) / 2) end) as max_pairwise_smd
           from sc_m a join sc_m b on a.variable = b.variable and a.g < b.g group by a.variable) p on v.variable = p.variable""")
cte("anova_stats", ("sc_m",), """
select variable, ((snm2 - sx * sx / n_total) / (k - 1)) / (ssw / (n_total - k)) as f_statistic,
  cast(k - 1 as bigint) as df1, cast(n_total - k as bigint) as df2
from (select variable, count(*) as k, sum(n) as n_total, sum(sx) as sx, sum(n * mean * mean) as snm2,
        sum(coalesce((n - 1) * var, 0)) as ssw from sc_m group by variable) where k >= 2""")
cte("cat_long", ("baseline_analysis",), "\nunion all\n".join(
    f"select menopause_group as g, '{v}' as variable, coalesce(cast({v} as varchar), 'Missing') as level from baseline_analysis where menopause_group is not null"
    for v in _CAT))
_decl_rows = [(v, l) for v in _CAT for l in list(_DECL.get(v, ())) + ["Missing"]]
cte("cat_c", ("cat_long",), """
select l.variable, l.level, n.g, coalesce(c.cnt, 0) as cnt, n.n from (
  select distinct variable, level from cat_long union select * from (values """ + ", ".join(f"({_q(v)}, {_q(l)})" for v, l in _decl_rows) + """) t(variable, level)) l
join (select variable, g, count(*) as n from cat_long group by variable, g) n on l.variable = n.variable
left join (select variable, level, g, count(*) as cnt from cat_long group by variable, level, g) c
  on c.variable = l.variable and c.level = l.level and c.g = n.g""")
cte("smd_categorical", ("cat_c",), """
select variable, level, level_pairwise_smd, max(level_pairwise_smd) over (partition by variable) as max_pairwise_smd from (
  select l.variable, l.level, s.smd as level_pairwise_smd from (select distinct variable, level from cat_c) l
  left join (select a.variable, a.level, max(case when (a.p * (1 - a.p) + b.p * (1 - b.p)) / 2 = 0 then cast(0 as double)
                 else abs(a.p - b.p) / sqrt((a.p * (1 - a.p) + b.p * (1 - b.p)) / 2) end) as smd
             from (select *, cnt / n as p from cat_c) a join (select *, cnt / n as p from cat_c) b
               on a.variable = b.variable and a.level = b.level and a.g < b.g group by a.variable, a.level) s
  on l.variable = s.variable and l.level = s.level)""")
cte("chisq_nonempty", ("cat_c",), """
select variable, sum(case when r > 0 and c > 0 then pow(abs(cnt - e) - case when yates then least(0.5, abs(cnt - e)) else 0 end, 2) / e else 0 end) as chi_square,
  cast((max(rr) - 1) * (max(cc) - 1) as bigint) as df
from (select *, r * c / nn as e, rr = 2 and cc = 2 as yates from (
  select *, sum(cnt) over (partition by variable, level) as r, sum(cnt) over (partition by variable, g) as c,
    sum(cnt) over (partition by variable) as nn from cat_c) x
  join (select variable as v2, count(distinct case when r2 > 0 then level end) as rr from (
          select variable, level, sum(cnt) as r2 from cat_c group by variable, level) group by variable) y on x.variable = y.v2
  join (select variable as v3, count(distinct g) as cc from cat_c where n > 0 group by variable) z on x.variable = z.v3)
group by variable having (max(rr) - 1) * (max(cc) - 1) >= 1""")
cte("chisq_stats", ("chisq_nonempty", "cat_c"), f"""
select c.variable, case when e.empty then null else c.chi_square end as chi_square, c.df from chisq_nonempty c
join (select x.variable, bool_or(x.r = 0) or max(y.k) < {len(GROUP_LEVELS)} as empty
      from (select variable, level, sum(cnt) as r from cat_c group by variable, level) x
      join (select variable, count(distinct g) as k from cat_c where n > 0 group by variable) y on x.variable = y.variable
      group by x.variable) e on c.variable = e.variable""")


# ---- model inputs ---------------------------------------------------------------
cte("lmm_moments", ("model2",), """
select hhidpn, cast(count(*) as bigint) as n, """ + ", ".join(
    f"sum(pow(age_c65, {k})) as s{k}" for k in range(5)) + ", " + ", ".join(
    f"sum(pow(age_c65, {k}) * cognitive_score) as z{k}" for k in range(3)) + """,
  sum(cognitive_score * cognitive_score) as yy, cast(0 as double) as lw,
  first(menopause_group) as menopause_group, first(race_ethnicity) as race_ethnicity,
  first(birth_year_c10) as birth_year_c10, first(education_c12) as education_c12, first(baseline_normal) as baseline_normal
from model2 group by hhidpn""")


# Model 2's columns in R's term order, written out: (name, group level, race
# level, numeric covariate, power of age - 65)
_DESIGN2 = (
    [("(Intercept)", None, None, None, 0)]
    + [("menopause_group" + g, g, None, None, 0) for g in GROUP_LEVELS[1:]]
    + [("age_c65", None, None, None, 1)]
    + [("race_ethnicity" + r, None, r, None, 0) for r in RACE_LEVELS[1:]]
    + [(v, None, None, v, 0) for v in ("birth_year_c10", "education_c12")]
    + [("menopause_group" + g + ":age_c65", g, None, None, 1) for g in GROUP_LEVELS[1:]]
)


def _is(column: str, level: str | None) -> str:
    return f" * (case when {column} = {_q(level)} then 1.0 else 0.0 end)" if level else ""


cte("design_matrix", ("model2",), "\nunion all\n".join(
    f"select hhidpn, wave, {j} as term_index, {_q(name)} as term, cast(pow(age_c65, {power}){_is('menopause_group', g)}"
    f"{_is('race_ethnicity', r)}{f' * cast({v} as double)' if v else ''} as double) + 0.0 as value from model2"
    for j, (name, g, r, v, power) in enumerate(_DESIGN2)))

cte("covdist", ("model2",), """
select hhidpn, race_ethnicity, birth_year_c10, education_c12 from (
  select *, row_number() over (partition by hhidpn order by wave) as rn from model2) where rn = 1""")



def _mean(race: str | None, numeric: str | None) -> str:
    if race:
        return f" * (select avg(case when race_ethnicity = {_q(race)} then cast(1 as double) else 0 end) from covdist)"
    return f" * (select avg(cast({numeric} as double)) from covdist)" if numeric else ""


cte("average_design", ("covdist",), "select * from (with grid as (select * from (values " + ", ".join(
    f"(cast({a} as double), {_q(g)})" for a in (65, 75, 85) for g in GROUP_LEVELS) + ") t(age, grp))\n" + "\nunion all\n".join(
    f"select age as chronological_age, grp as menopause_group, {j} as term_index, {_q(name)} as term, "
    f"cast(pow(age - 65, {power}){_is('grp', g)}{_mean(r, v)} as double) as value from grid"
    for j, (name, g, r, v, power) in enumerate(_DESIGN2)) + ")")


_JOINT = (
    [("(Intercept)", None, "1.0", 0)] + [("menopause_group" + g, g, "1.0", 0) for g in GROUP_LEVELS[1:]] + [("age_c65", None, "1.0", 1)]
    + [("race_ethnicity" + r, None, f"(race_ethnicity = {_q(r)})::int", 0) for r in RACE_LEVELS[1:]]
    + [("education_c12", None, "education_c12", 0)]
    + [("race_ethnicity" + r + ":education_c12", None, f"(race_ethnicity = {_q(r)})::int * education_c12", 0) for r in RACE_LEVELS[1:]]
    + [("menopause_group" + g + ":birth_year_c10:education_c12", g, "birth_year_c10 * education_c12", 0) for g in GROUP_LEVELS[1:]]
)
cte("average_design_joint", ("covdist",), "select * from (with grid as (select * from (values " + ", ".join(
    f"(cast({a} as double), {_q(g)})" for a in (65, 75, 85) for g in GROUP_LEVELS) + ") t(age, grp))\n" + "\nunion all\n".join(
    f"select age as chronological_age, grp as menopause_group, cast({j} as integer) as term_index, {_q(name)} as term, "
    f"cast(pow(age - 65, {power}){_is('grp', g)} * (select avg(cast({e} as double)) from covdist) as double) + 0.0 as value from grid"
    for j, (name, g, e, power) in enumerate(_JOINT)) + ")")


# ---- LOESS fit (B11) --------------------------------------------------------------
cte("loess_hist", ("analysis",), """
select menopause_group as g, cast(chronological_age as double) as x, count(*) as n, sum(cognitive_score) as sy
from analysis where chronological_age is not null and cognitive_score is not null and menopause_group is not null
  and chronological_age >= 50 and cognitive_score >= 0 and cognitive_score <= 27
group by menopause_group, cast(chronological_age as double)""")
cte("loess_curve", ("loess_hist",), """
select g as menopause_group, cast(grid_index as integer) as grid_index, x0 as chronological_age,
  ((t0 * (s2 * s4 - s3 * s3)) - (s1 * (t1 * s4 - s3 * t2)) + (s2 * (t1 * s3 - s2 * t2)))
  / ((s0 * (s2 * s4 - s3 * s3)) - (s1 * (s1 * s4 - s3 * s2)) + (s2 * (s1 * s3 - s2 * s2))) as fit
from (
  select g, grid_index, x0, sum(w * n) as s0, sum(w * n * d) as s1, sum(w * n * pow(d, 2)) as s2, sum(w * n * pow(d, 3)) as s3,
    sum(w * n * pow(d, 4)) as s4, sum(w * sy) as t0, sum(w * sy * d) as t1, sum(w * sy * pow(d, 2)) as t2
  from (
    select *, case when ad / h < 1 then pow(1 - pow(ad / h, 3), 3) else 0 end as w from (
      select *, min(case when cum >= q then ad end) over (partition by g, grid_index) * greatest(1.0, 0.75) as h from (
        select *, sum(n) over (partition by g, grid_index order by ad rows between unbounded preceding and current row) as cum
        from (select p.g, p.grid_index, p.x0, p.q, h.x, h.n, h.sy, h.x - p.x0 as d, abs(h.x - p.x0) as ad
              from (select g, floor(n_total * 0.75) as q, i as grid_index, lo + i * (hi - lo) / 79 as x0
                    from (select g, sum(n) as n_total, min(x) as lo, max(x) as hi from loess_hist group by g), range(80) t(i)) p
              join loess_hist h on p.g = h.g)))) group by g, grid_index, x0)""")


# The surface between cell borders: cells are cut at the middle of their points
# while they hold more than 0.75 * 0.2 of all, then value and slope are fitted at
# the borders and blended.
cte("loess_borders", ("loess_hist",), """
with recursive cum as (select g, x, n, sum(n) over (partition by g order by x) as upto from loess_hist),
cells as (
  select g, cast(0 as hugeint) as first, n - 1 as last, lo - 0.1 * greatest(hi - lo, 1e-10 * greatest(abs(lo), abs(hi)) + 1e-30) as lo,
    hi + 0.1 * greatest(hi - lo, 1e-10 * greatest(abs(lo), abs(hi)) + 1e-30) as hi, floor(n * 0.75 * 0.2) as most
  from (select g, sum(n) as n, min(x) as lo, max(x) as hi from loess_hist group by g)
  union all
  select g, case when side = 0 then first else upto end, case when side = 0 then upto - 1 else last end,
    case when side = 0 then lo else cut end, case when side = 0 then cut else hi end, most
  from (select c.*, a.upto, (a.x + b.x) / 2 as cut
    from cells c join cum a on a.g = c.g and (first + last) // 2 < a.upto and (first + last) // 2 >= a.upto - a.n
      join cum b on b.g = c.g and (first + last) // 2 + 1 < b.upto and (first + last) // 2 + 1 >= b.upto - b.n
    where last - first + 1 > most), (values (0), (1)) s(side)
  where lo < cut and cut < hi and first <= upto - 1 and upto - 1 < last)
select g, x0, row_number() over (partition by g order by x0) - 1 as i from (select g, lo as x0 from cells union select g, hi from cells)""")
cte("loess_at_borders", ("loess_hist", "loess_borders"), """
select g, i, x0, (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / det as fit,
  (s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / det as slope
from (select *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) as det from (
  select g, i, x0, sum(w * n) as s0, sum(w * n * d) as s1, sum(w * n * pow(d, 2)) as s2, sum(w * n * pow(d, 3)) as s3,
    sum(w * n * pow(d, 4)) as s4, sum(w * sy) as t0, sum(w * sy * d) as t1, sum(w * sy * pow(d, 2)) as t2
  from (
    select *, case when abs(d) / h < 1 then pow(1 - pow(abs(d) / h, 3), 3) else 0 end as w from (
      select *, min(case when cum >= q then abs(d) end) over (partition by g, i) as h from (
        select *, sum(n) over (partition by g, i order by abs(d) rows between unbounded preceding and current row) as cum
        from (select b.g, b.i, b.x0, t.q, h.n, h.sy, h.x - b.x0 as d
          from loess_borders b join (select g, floor(sum(n) * 0.75) as q from loess_hist group by g) t on t.g = b.g
            join loess_hist h on h.g = b.g)))) group by g, i, x0))""")
cte("loess_surface", ("loess_hist", "loess_at_borders"), """
select g as menopause_group, cast(grid_index as integer) as grid_index, x0 as chronological_age,
  pow(1 - t, 2) * (1 + 2 * t) * fa + t * t * (3 - 2 * t) * fb + t * pow(1 - t, 2) * (b - a) * sa - t * t * (1 - t) * (b - a) * sb as fit
from (select p.*, l.x0 as a, r.x0 as b, l.fit as fa, r.fit as fb, l.slope as sa, r.slope as sb, (p.x0 - l.x0) / (r.x0 - l.x0) as t
  from (select g, i as grid_index, lo + i * (hi - lo) / 79 as x0
    from (select g, min(x) as lo, max(x) as hi from loess_hist group by g), range(80) t(i)) p
  join loess_at_borders l on l.g = p.g and l.x0 <= p.x0 join loess_at_borders r on r.g = p.g and r.i = l.i + 1 and p.x0 < r.x0)""")
cte("score_quantiles", ("analysis",), """
select menopause_group, wave, count(cognitive_score) as n, quantile_cont(cast(cognitive_score as double), 0.01) as p01,
  quantile_cont(cast(cognitive_score as double), 0.5) as median, quantile_cont(cast(cognitive_score as double), 0.99) as p99
from analysis where menopause_group is not null and cognitive_score is not null group by menopause_group, wave""")


# The band: the smoother's rows at the grid and at the observed x, M = (I-L)(I-L)'
# over the distinct x with their counts, and the t quantile by its expansion in 1/df.
def _t975(df: str) -> str:
    z = 1.959963984540054
    terms = (z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
             (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160)
    return "(" + " + ".join(f"{t!r} / pow({df}, {k})" for k, t in enumerate(terms)) + ")"


cte("loess_points", ("analysis",), """
with h as (
  select menopause_group as g, cast(chronological_age as double) as x, count(*) as n, sum(cognitive_score) as sy,
    sum(cast(cognitive_score as double) * cognitive_score) as syy
  from analysis where chronological_age is not null and cognitive_score is not null and menopause_group is not null
    and chronological_age >= 50 and cognitive_score >= 0 and cognitive_score <= 27
  group by menopause_group, cast(chronological_age as double)),
per_g as (select g, sum(n) as n_total, min(x) as lo, max(x) as hi from h group by g),
p as (
  select g, floor(n_total * 0.75) as q, i as grid_index, lo + i * (hi - lo) / 79 as x0 from per_g, range(80) t(i)
  union all select h.g, floor(n_total * 0.75), -1, x from h join per_g on h.g = per_g.g),
near as (
  select p.g, grid_index, x0, q, x, n, sy, syy, x - x0 as d, abs(x - x0) as ad,
    sum(n) over (partition by p.g, grid_index, x0 order by abs(x - x0) rows between unbounded preceding and current row) as cum
  from p join h on p.g = h.g),
wide as (select *, min(case when cum >= q then ad end) over (partition by g, grid_index, x0) as width from near)
select *, case when ad / width < 1 then pow(1 - pow(ad / width, 3), 3) else 0 end as w from wide""")
cte("loess_rows", ("loess_points",), """
select *, (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / det as fit,
  (s2 * s4 - s3 * s3) / det as c0, -(s1 * s4 - s2 * s3) / det as c1, (s1 * s3 - s2 * s2) / det as c2
from (select *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) as det from (
  select g, grid_index, x0, """ + ", ".join(f"sum(w * n * pow(d, {k})) as s{k}" for k in range(5)) + ", "
    + ", ".join(f"sum(w * sy * pow(d, {k})) as t{k}" for k in range(3)) + """
  from loess_points group by g, grid_index, x0))""")
cte("loess_smoother", ("loess_points", "loess_rows"), """
select p.g, p.grid_index, p.x0 as i, p.x as j, p.n, p.sy, p.syy, r.fit, p.w * (r.c0 + r.c1 * p.d + r.c2 * p.d * p.d) as l
from loess_points p join loess_rows r on p.g = r.g and p.grid_index = r.grid_index and p.x0 = r.x0""")
cte("loess_scale", ("loess_smoother",), """
with o as (select * from loess_smoother where grid_index < 0),
m as (
  select a.g, a.i, b.i as j, sum(a.n * a.l * b.l) as h from o a join o b on a.g = b.g and a.j = b.j group by a.g, a.i, b.i),
e as (
  select m.g, m.i, m.j, m.h - x.l - y.l as v, x.l as l, x.n as nj, y.n as ni
  from m join o x on x.g = m.g and x.i = m.i and x.j = m.j join o y on y.g = m.g and y.i = m.j and y.j = m.i),
tr as (
  select g, sum(case when i = j then ni * l end) as enp, sum(case when i = j then ni * (1 + v) end) as d1,
    sum(ni * nj * v * v) + sum(case when i = j then ni * (1 + 2 * v) end) as d2 from e group by g),
rss as (select g, sum(syy - 2 * fit * sy + n * fit * fit) as rss from o where i = j group by g)
select tr.g, enp, sqrt(rss / d1) as s, d1 * d1 / d2 as df from tr join rss on tr.g = rss.g""")
cte("loess_band", ("loess_smoother", "loess_scale"), f"""
select menopause_group, grid_index, chronological_age, fit, std_error, fit - t * std_error as conf_low,
  fit + t * std_error as conf_high, equivalent_parameters
from (select x.g as menopause_group, cast(grid_index as integer) as grid_index, i as chronological_age, max(fit) as fit,
    max(s) * sqrt(sum(n * l * l)) as std_error, max({_t975("df")}) as t, max(enp) as equivalent_parameters
  from loess_smoother x join loess_scale z on x.g = z.g where grid_index >= 0 group by x.g, grid_index, i)""")


# ---- validation and small reports ---------------------------------------------------
_HAVE_WAVE = ("baseline_rows", "analytic_allwaves", "modelready", "model2")
cte("input_validation", ("baseline_person", "baseline_analysis", "analysis_all", "analysis", "model2", "covdist"), "\nunion all\n".join(
    f"select '{n}' as input, cast(count(*) as bigint) as n_rows, cast(count(distinct hhidpn) as bigint) as n_persons, "
    f"{'min(wave)' if n in _HAVE_WAVE else 'cast(null as integer)'} as min_wave, "
    f"{'max(wave)' if n in _HAVE_WAVE else 'cast(null as integer)'} as max_wave from {t}"
    for n, t in (("baseline_person", "baseline_person"), ("baseline_rows", "baseline_analysis"), ("analytic_allwaves", "analysis_all"),
                 ("modelready", "analysis"), ("model2", "model2"), ("standardization", "covdist"))))
cte("surgical_absorbing", ("base",), """
select hhidpn, wave, surgical_now,
  max(cast(surgical_now as integer)) over (partition by hhidpn order by wave rows between unbounded preceding and current row) = 1 as surgical_absorbing
from (select hhidpn, wave, coalesce(meno_combo = '6.Surgical', false) as surgical_now from base)""")
cte("invariant_cases", ("invariant_diag",), "select * from invariant_diag where inconsistent")
_LABELS = (("baseline_age", "Baseline age, years"), ("baseline_cognition", "Baseline cognitive score, 0-27"), ("birth_year", "Birth year"),
           ("education_years", "Education, years"), ("race_ethnicity", "Race/ethnicity"), ("education_category", "Education category"),
           ("birth_cohort_decade", "Birth cohort decade"), ("baseline_cognitive_status", "Baseline cognitive status"))
cte("smd_diagnostics", ("smd_continuous", "smd_categorical"), """
select c.variable, l.label, 'continuous' as covariate_type, cast(null as varchar) as level, cast(null as double) as level_pairwise_smd,
  c.max_pairwise_smd
from smd_continuous c left join (values """ + ", ".join(f"({_q(v)}, {_q(l)})" for v, l in _LABELS) + """) l(variable, label) on c.variable = l.variable
union all
select c.variable, l.label, 'categorical', c.level, c.level_pairwise_smd, c.max_pairwise_smd
from smd_categorical c left join (values """ + ", ".join(f"({_q(v)}, {_q(l)})" for v, l in _LABELS) + """) l(variable, label) on c.variable = l.variable""")
cte("smd_top", ("smd_diagnostics",), """
select * from smd_diagnostics order by max_pairwise_smd desc nulls last, variable asc nulls last,
  level_pairwise_smd desc nulls last, level asc nulls last limit 12""")
cte("model_samples", ("analysis", "model2"), """
select m.model, m.n_person_waves, m.n_persons, r.rr - m.n_person_waves as exclusions_relative_to_phase2_modelready_rows,
  r.rp - m.n_persons as exclusions_relative_to_phase2_modelready_persons
from (select 'Model 0 and Model 1' as model, cast(count(*) as bigint) as n_person_waves, cast(count(distinct hhidpn) as bigint) as n_persons from analysis
      union all select 'Model 2', cast(count(*) as bigint), cast(count(distinct hhidpn) as bigint) from model2
      union all select 'Model 6', cast(count(*) as bigint), cast(count(distinct hhidpn) as bigint) from model2 where baseline_normal = 1
      union all select 'Model 7', cast(count(*) as bigint), cast(count(distinct hhidpn) as bigint) from model2
        where menopause_group in """ + _in(NATURAL_GROUPS) + """) m,
     (select cast(count(*) as bigint) as rr, cast(count(distinct hhidpn) as bigint) as rp from analysis) r""")


# ---- Table 1 (formatted) ---------------------------------------------------------------
def _f_tail(f, d1, d2):
    """Upper F tail: 1 minus the series of the incomplete beta function."""
    a, b, y = f"({d1} / 2.0)", f"({d2} / 2.0)", f"({d1} * {f} / ({d2} + {d1} * {f}))"
    term = (f"exp(lgamma({a} + {b} + k) - lgamma({b}) - lgamma({a} + k + 1) + ({a} + k) * ln({y}) + {b} * ln(1 - {y}))")
    return f"case when {f} is null then null when {f} <= 0 then 1 else 1 - list_sum(list_transform(range(0, 3000), lambda k: {term})) end"


def _chi2_tail(x, df):
    """Upper chi-square tail: 1 minus the series of the incomplete gamma function."""
    term = f"exp(({df} / 2.0 + k) * ln({x} / 2) - {x} / 2 - lgamma({df} / 2.0 + k + 1))"
    return (f"case when {x} is null then null when {x} <= 0 then 1 when {x} > 600 then 0 "
            f"else 1 - list_sum(list_transform(range(0, 2000), lambda k: {term})) end")


def _ptext(p):
    return f"case when {p} is null or isnan({p}) then '' when {p} < 0.001 then '<0.001' else {_fx(p, 3)} end"


cte("anova_p", ("anova_stats",), f"select variable, {_f_tail('f_statistic', 'df1', 'df2')} as p from anova_stats")
cte("chisq_p", ("chisq_stats",), f"select variable, {_chi2_tail('chi_square', 'df')} as p from chisq_stats")


def _fx(e, d):
    return f"cast(cast(round(cast({e} as decimal(38,10)), {d}) as decimal(38,{d})) as varchar)"


def _th(e):
    return f"format('{{:,}}', cast({e} as bigint))"


def _msd(m, sd, n):
    return f"case when {n} is null or {n} = 0 then '' else {_fx(m, 2)} || ' (' || coalesce({_fx(sd, 2)}, 'NA') || ')' end"


def _npct(n, d):
    return f"case when {d} is null or {d} = 0 then '' else {_th(n)} || ' (' || {_fx(f'cast({n} as double) * 100 / {d}', 1)} || '%)' end"


def _fsmd(x):
    return f"case when {x} is null or isnan({x}) then '' when {x} < 0.001 then '<0.001' else {_fx(x, 3)} end"


_GL = [(g, GROUP_LABELS[g]) for g in GROUP_LEVELS]
cte("t1_long", ("baseline_analysis",), "\nunion all\n".join(
    f"select menopause_group as g, '{v}' as variable, cast({v} as double) as x from baseline_analysis" for v in _CONT))
cte("table1_n", ("baseline_analysis",), "select cast(null as varchar) as variable, 0 as row_order, 'N' as \"Characteristic\", '' as \"Level\", "
    + _th("count(*)") + " as \"Overall\", " + ", ".join(
        _th(f"count_if(menopause_group = {_q(g)})") + f' as "{lab}"' for g, lab in _GL)
    + ", '' as \"Missing\", '' as \"P value\", '' as \"Max pairwise SMD\" from baseline_analysis")
cte("table1_continuous", ("t1_long", "smd_continuous", "anova_p"), "select v.variable, v.i + 1 as row_order, v.label as \"Characteristic\", "
    "'Mean (SD)' as \"Level\", " + _msd("o.mean", "o.sd", "o.n") + " as \"Overall\", " + ", ".join(
        f'coalesce(w."{lab}", \'\') as "{lab}"' for _, lab in _GL)
    + ", " + _th("o.nmiss") + " as \"Missing\", " + _ptext("a.p") + " as \"P value\", " + _fsmd("s.max_pairwise_smd") + """ as "Max pairwise SMD"
from (values """ + ", ".join(f"({_q(v)}, {_q(l)}, {i})" for i, (v, l) in enumerate(_LABELS[:4])) + """) v(variable, label, i)
left join (select variable, count(x) as n, avg(x) as mean, stddev_samp(x) as sd, count_if(x is null) as nmiss from t1_long group by variable) o
  on v.variable = o.variable
left join (select variable, """ + ", ".join(f'max(case when g = {_q(g)} then str end) as "{lab}"' for g, lab in _GL) + """
           from (select variable, g, """ + _msd("avg(x)", "stddev_samp(x)", "count(x)") + """ as str from t1_long where g is not null group by variable, g)
           group by variable) w on v.variable = w.variable
left join smd_continuous s on v.variable = s.variable left join anova_p a on v.variable = a.variable""")
_pos_case = "case " + " ".join(f"when variable = {_q(v)} and level = {_q(l)} then {i}" for v, lv in _DECL.items() for i, l in enumerate(lv)) \
    + " when level = 'Missing' then 1000000 end"
cte("table1_categorical", ("cat_c", "smd_categorical", "chisq_p"), """
select c.variable, v.i * 100 + c.lv + 100 as row_order, v.label as "Characteristic", c.level as "Level",
  """ + _npct("c.r", "c.total") + """ as "Overall", """ + ", ".join(
    f'coalesce(c."{lab}", \'\') as "{lab}"' for _, lab in _GL) + """, '' as "Missing", case when c.lv = 1 then """ + _ptext("x.p") + """ else '' end as "P value",
  case when c.lv = 1 then """ + _fsmd("s.max_pairwise_smd") + """ else '' end as "Max pairwise SMD"
from (select *, cast(row_number() over (partition by variable order by pos asc nulls first, level) as integer) as lv,
        sum(r) over (partition by variable) as total from (
        select variable, level, """ + _pos_case.replace("variable =", "variable =") + """ as pos, sum(cnt) as r, """ + ", ".join(
    f'max(case when g = {_q(g)} then {_npct("cnt", "n")} end) as "{lab}"' for g, lab in _GL) + """
        from cat_c group by variable, level)) c
join (values """ + ", ".join(f"({_q(v)}, {_q(l)}, {i})" for i, (v, l) in enumerate(_LABELS[4:])) + """) v(variable, label, i) on c.variable = v.variable
left join smd_categorical s on c.variable = s.variable and c.level = s.level left join chisq_p x on c.variable = x.variable""")
cte("table1", ("table1_n", "table1_continuous", "table1_categorical"), """
select * from table1_n union all by name select * from table1_continuous union all by name select * from table1_categorical""")


# ---- per-phase validation tables ------------------------------------------------------
cte("validation_phase3", ("baseline_person", "baseline_analysis", "analysis"), """
select (select cast(count(*) as bigint) from baseline_person) as phase2_baseline_persons,
       (select cast(count(*) as bigint) from baseline_analysis) as phase3_baseline_rows,
       (select cast(count(*) as bigint) from analysis) as phase4_modelready_person_waves,
       (select cast(count(distinct hhidpn) as bigint) from analysis) as phase4_modelready_persons""")
cte("validation_phase5", ("analysis_all", "analysis", "model2"), """
select (select cast(count(*) as bigint) from analysis_all) as phase2_allwaves_rows,
       (select cast(count(*) as bigint) from analysis) as phase2_modelready_rows,
       (select cast(count(*) as bigint) from model2) as model2_complete_case_rows,
       (select cast(count(distinct hhidpn) as bigint) from model2) as model2_complete_case_persons""")
cte("validation_phase7", ("model2", "covdist"), """
select (select cast(count(*) as bigint) from model2) as model2_person_waves,
       (select cast(count(distinct hhidpn) as bigint) from model2) as model2_persons,
       (select min(chronological_age) from model2) as min_age_model2_data,
       (select max(chronological_age) from model2) as max_age_model2_data,
       (select cast(count(*) as bigint) from covdist) as person_rows_for_standardization""")


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql_for(final: str, select: str | None = None) -> str:
    """Full SQL for one result: the needed CTEs, then ``select``
    (default: every row of CTE ``final``)."""
    names = _order([final])
    body = ",\n".join(f"{n} as (\n{CTES[n][1]}\n)" for n in names)
    return f"with {body}\nselect * from {final}" if select is None else f"with {body}\n{select}"
