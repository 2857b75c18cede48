"""Hand fixtures for the panel integrity operators."""

from wavecohort.operators import integrity as I


def test_mode_first_tie_is_earliest_wave(panel_of):
    p = panel_of([
        dict(hhidpn=1, wave=1, C253_age=45.0), dict(hhidpn=1, wave=2, C253_age=47.0),
        dict(hhidpn=1, wave=3, C253_age=47.0), dict(hhidpn=1, wave=4, C253_age=45.0),
        dict(hhidpn=2, wave=1, C253_age=None), dict(hhidpn=2, wave=2, C253_age=None),
        dict(hhidpn=3, wave=2, C253_age=51.0), dict(hhidpn=3, wave=1, C253_age=52.0),
    ])
    got = {r["hhidpn"]: r for r in I.exposure_age(p).collect()}
    assert got[1]["menopause_age_resolved"] == 45.0
    assert got[1]["menopause_age_n_reports"] == 4 and got[1]["menopause_age_n_distinct"] == 2
    assert got[2]["menopause_age_resolved"] is None and got[2]["menopause_age_n_reports"] == 0
    assert got[3]["menopause_age_resolved"] == 52.0  # wave 1 is first in wave order


def test_first_assessment_orders_by_age_then_wave(panel_of):
    p = panel_of([
        dict(hhidpn=1, wave=1, agey_e=62.0), dict(hhidpn=1, wave=2, agey_e=61.0),
        dict(hhidpn=1, wave=3, agey_e=61.0), dict(hhidpn=2, wave=1, cogtot27_imp=None),
    ])
    got = {r["hhidpn"]: r for r in I.first_assessment(p).collect()}
    assert got[1]["first_cog_wave"] == 2
    assert 2 not in got


def test_temporal_violation_and_ambiguity(panel_of):
    p = panel_of([
        dict(hhidpn=1, wave=1, agey_e=48.0, C253_age=50.0),
        dict(hhidpn=2, wave=1, agey_e=55.0, C253_age=50.0), dict(hhidpn=2, wave=2, agey_e=57.0, C253_age=56.0),
        dict(hhidpn=2, wave=3, agey_e=59.0, C253_age=50.0),
    ])
    got = {r["hhidpn"]: r for r in I.temporal_order(p).collect()}
    assert got[1]["temporal_order_violation"] and not got[1]["temporal_order_ambiguous"]
    assert not got[2]["temporal_order_violation"] and got[2]["temporal_order_ambiguous"]


def test_status_path(panel_of):
    p = panel_of([
        dict(hhidpn=1, wave=1, meno_status_time="Postmenopausal"), dict(hhidpn=1, wave=2, meno_status_time="Unknown"),
        dict(hhidpn=1, wave=3, meno_status_time="Premenopausal"),
        dict(hhidpn=2, wave=1, meno_status_time="Premenopausal"), dict(hhidpn=2, wave=2, meno_status_time="Postmenopausal"),
        dict(hhidpn=3, wave=1, meno_status_time="Perimenopausal"),
    ])
    tr = {(r["hhidpn"], r["wave"]): r for r in I.transitions(p).collect()}
    assert tr[(1, 3)]["backward_meno_transition"] is True
    assert tr[(1, 2)]["backward_meno_transition"] is None
    assert tr[(2, 2)]["backward_meno_transition"] is False
    assert tr[(3, 1)]["meno_status_standard"] is None
    person = {r["hhidpn"]: r for r in I.transition_person(I.transitions(p)).collect()}
    assert person[1]["any_backward_meno_transition"] and person[1]["first_backward_wave"] == 3
    assert person[1]["status_sequence"] == "1:postmenopausal -> 2:missing_or_unknown -> 3:premenopausal"
    assert not person[3]["any_backward_meno_transition"]


def test_missingness_patterns(panel_of):
    # waves 1..3 exist in the extract; person 6 enters at wave 2
    rows = [
        dict(hhidpn=1, wave=1), dict(hhidpn=1, wave=2), dict(hhidpn=1, wave=3),              # OOO
        dict(hhidpn=2, wave=1), dict(hhidpn=2, wave=2, cogtot27_imp=None), dict(hhidpn=2, wave=3),  # OMO
        dict(hhidpn=3, wave=1), dict(hhidpn=3, wave=2),                                       # OON
        dict(hhidpn=4, wave=1, cogtot27_imp=None), dict(hhidpn=4, wave=2), dict(hhidpn=4, wave=3),  # MOO
        dict(hhidpn=5, wave=1, cogtot27_imp=None), dict(hhidpn=5, wave=2, cogtot27_imp=None),  # MMN
        dict(hhidpn=6, wave=2), dict(hhidpn=6, wave=3),                                       # OO
    ]
    mp = I.missing_panel(panel_of(rows))
    got = {r["hhidpn"]: r for r in I.missingness_person(mp).collect()}
    assert got[1]["missingness_pattern"] == "OOO" and got[1]["missingness_class"] == "complete_from_entry_to_last_wave"
    assert got[2]["missingness_pattern"] == "OMO" and got[2]["missingness_class"] == "intermittent_missingness"
    assert got[3]["missingness_pattern"] == "OON" and got[3]["missingness_class"] == "monotone_missingness_attrition_compatible"
    assert got[4]["missingness_class"] == "missing_before_first_valid_cognition_only"
    assert got[5]["missingness_pattern"] == "MMN" and got[5]["missingness_class"] == "zero_valid_cognitive_assessments"
    assert got[6]["missingness_pattern"] == "OO" and got[6]["missingness_class"] == "complete_from_entry_to_last_wave"
    by_wave = I.missingness_by_wave(mp).collect()
    assert sum(r["persons_in_risk_set"] for r in by_wave) == mp.count()


def test_resolve_invariants_overwrites_nulls(panel_of):
    p = panel_of([
        dict(hhidpn=1, wave=1, raeduc=2), dict(hhidpn=1, wave=2, raeduc=3), dict(hhidpn=1, wave=3, raeduc=3),
        dict(hhidpn=1, wave=4, raeduc=None),
    ])
    got = {r["wave"]: r["raeduc"] for r in I.resolve_invariants(p).collect()}
    assert got == {1: 3, 2: 3, 3: 3, 4: 3}
    diag = {(r["hhidpn"], r["variable"]): r for r in I.invariant_diag(p).collect()}
    assert diag[(1, "raeduc")]["observed_values"] == "2 | 3" and diag[(1, "raeduc")]["inconsistent"]


def test_absorbing_state(panel_of):
    p = panel_of([dict(hhidpn=1, wave=w, C253_major_inconsistency=v) for w, v in ((1, 0), (2, 1), (3, 0))])
    d = I.absorbing_state(p, "C253_major_inconsistency", "ever", )
    got = {r["wave"]: r["ever"] for r in d.collect()}
    assert got == {1: False, 2: True, 3: True}


def test_modes_unpivot_versions_of_a_person_not_rows(spark):
    """Rows that agree count together before the unpivot; modes and ties are
    those of the single rows."""
    from wavecohort.operators import integrity

    rows = [(1, w, 1, 1940 if w < 4 else 1941) for w in range(1, 9)]  # 1941 leads 5 to 3
    rows += [(2, 1, 2, None), (2, 2, 1, 1930), (2, 3, 1, 1931), (2, 4, 2, None)]  # ties: the first seen
    rows += [(3, 1, None, None), (3, 2, None, None)]
    rows += [(4, 1, 1, 1950), (4, 2, 2, 1950), (4, 3, 3, 1951), (4, 4, 3, 1952)]  # the mode spans versions
    panel = spark.createDataFrame(rows, "hhidpn long, wave int, raracem int, rabyear int")
    found = integrity.invariant_modes(panel, variables=["raracem", "rabyear"])
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 1941), (2, 2, 1930), (3, None, None), (4, 3, 1950)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "count(1)" in plan[plan.index("Generate") :]  # the aggregate lies below the unpivot
