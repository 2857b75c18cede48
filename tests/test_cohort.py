"""Hand fixtures for eligibility, Time Zero and the exclusion cascade."""

from wavecohort.operators import cohort as C


def test_eligibility_three_valued(panel_of):
    p = panel_of([
        dict(hhidpn=1, wave=1, Female=None, ragender=2),             # female by fallback
        dict(hhidpn=2, wave=1, Female=None, ragender=None),          # unknown sex -> NULL, not eligible
        dict(hhidpn=3, wave=1, agey_e=49.0),                         # too young
        dict(hhidpn=4, wave=1, meno_combo="7.Premenopausal"),        # invalid exposure
        dict(hhidpn=5, wave=1, meno_combo=None),
    ])
    got = {r["hhidpn"]: r for r in C.eligibility(p).collect()}
    assert got[1]["is_female"] is True and got[1]["eligible_timezero_wave"] is True
    assert got[2]["is_female"] is None and got[2]["eligible_timezero_wave"] is None
    assert got[3]["eligible_timezero_wave"] is False
    assert got[4]["valid_menopause_exposure"] is False and got[5]["valid_menopause_exposure"] is False


def test_baseline_uses_own_row_and_cascade(panel_of):
    p = panel_of([
        # person 1: first eligible wave is 2 (wave 1 has no score); own exposure-age report 51
        dict(hhidpn=1, wave=1, cogtot27_imp=None, C253_age=50.0), dict(hhidpn=1, wave=2, C253_age=51.0),
        dict(hhidpn=1, wave=3, C253_age=50.0),
        # person 2: dementia at baseline
        dict(hhidpn=2, wave=1, cogfunction=3), dict(hhidpn=2, wave=2),
        # person 3: a man
        dict(hhidpn=3, wave=1, Female=0, ragender=1),
        # person 4: never a valid exposure
        dict(hhidpn=4, wave=1, meno_combo="8.Unknown type"),
    ])
    base = C.eligibility(p)
    bl = {r["hhidpn"]: r for r in C.baseline(base).collect()}
    assert bl[1]["baseline_wave"] == 2 and bl[1]["baseline_exposure_age"] == 51.0
    assert bl[2]["baseline_dementia"] is True and bl[2]["baseline_normal"] == 0
    steps = C.cohort_steps(C.cohort_flags(base), C.baseline(base))
    last = {r["hhidpn"]: r["last_step_passed"] for r in steps.collect()}
    assert last == {1: 5, 2: 4, 3: 0, 4: 1}
    casc = {r["step_index"]: r for r in C.exclusion_cascade(steps, base).collect()}
    assert casc[0]["n_persons_remaining"] == 4 and casc[0]["n_rows_remaining"] == 7
    assert casc[1]["n_persons_dropped"] == 1 and casc[5]["n_persons_remaining"] == 1
    assert casc[5]["n_rows_remaining"] == 3
    bp = C.baseline_person(C.baseline(base), steps)
    ap = C.analytic_panel(base, bp).collect()
    assert sorted(r["wave"] for r in ap) == [2, 3]
    assert all(r["time_since_baseline_wave"] == r["wave"] - 2 for r in ap)
