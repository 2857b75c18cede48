"""Hand fixtures for retention, Kaplan-Meier, IPCW weights and balance."""

import math

from pyspark.sql import functions as F

from wavecohort.operators import describe as D
from wavecohort.operators import ipcw as W
from wavecohort.operators import retention as R

LAB = "menopause_group_label"


def _events(spark, rows):
    return spark.createDataFrame(rows, f"hhidpn long, {LAB} string, time_to_attrition_or_censor double, attrition_event boolean")


def _model_rows(spark, rows):
    return spark.createDataFrame(
        rows, "hhidpn long, wave int, baseline_wave int, menopause_group string, menopause_group_label string, cogtot27_imp double")


def test_intermittent_miss_is_an_event_and_zero_time(spark):
    # person 1: observed, missed, observed -> event at follow-up 1
    # person 2: baseline in the last wave -> time 0, censored
    allw = _model_rows(spark, [(1, 1, 1, "g", "G", 20.0), (1, 2, 1, "g", "G", None), (1, 3, 1, "g", "G", 21.0),
                               (2, 3, 3, "g", "G", 22.0)])
    model = allw.where(F.col("cogtot27_imp").isNotNull())
    rp = R.retention_panel(model, allw, [1, 2, 3])
    ev = {r["hhidpn"]: r for r in R.attrition_events(rp).collect()}
    assert ev[1]["attrition_event"] and ev[1]["time_to_attrition_or_censor"] == 1.0
    assert not ev[2]["attrition_event"] and ev[2]["time_to_attrition_or_censor"] == 0.0


def test_km_survival_to_zero_and_monotone(spark):
    e = _events(spark, [(i, "A", 2.0, True) for i in range(3)] + [(10 + i, "B", float(1 + i % 3), i % 2 == 0) for i in range(9)])
    km = R.km_curve(e).collect()
    a = sorted((r for r in km if r[LAB] == "A"), key=lambda r: r["followup_wave"])
    assert a[0]["followup_wave"] == 0 and a[0]["n_risk"] == 3
    assert a[1]["retention_probability"] == 0.0 and a[1]["conf_low"] is None and a[1]["std_error"] is None
    b = sorted((r for r in km if r[LAB] == "B"), key=lambda r: r["followup_wave"])
    s = [r["retention_probability"] for r in b]
    assert all(x >= y for x, y in zip(s, s[1:]))
    # Greenwood by hand at the first event time: n=9, d=2
    g = 2 / (9 * 7)
    assert abs(b[1]["std_error"] - (7 / 9) * math.sqrt(g)) < 1e-12
    assert b[1]["conf_high"] <= 1.0


def test_returner_weight_factor_is_one(spark):
    # observed at 1 (baseline), missed at 2, observed at 3: not at risk at 3
    p = spark.createDataFrame(
        [(1, 1, 1, True, None), (1, 2, 1, False, True), (1, 3, 1, True, False)],
        "hhidpn long, wave int, baseline_wave int, observed_cognition boolean, lag_observed_cognition boolean")
    p = p.withColumn("at_risk_for_observation", (F.col("wave") > F.col("baseline_wave")) & F.col("lag_observed_cognition"))
    preds = spark.createDataFrame([(1, 2, 1.7), (1, 3, 1.9)], "hhidpn long, wave int, stabilized_transition_weight double")
    w = {r["wave"]: r for r in W.cumulative_weights(p, preds).collect()}
    assert w[1]["sw_cumulative"] == 1.0
    assert w[2]["transition_weight_for_observed_outcome"] == 1.0  # at risk but not observed
    assert w[3]["transition_weight_for_observed_outcome"] == 1.0 and w[3]["sw_cumulative"] == 1.0


def test_single_person_group_smd_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("b", 5.0)], "menopause_group string, x double")
    got = D.smd_continuous(df, ["x"]).first()
    assert got["max_pairwise_smd"] == 0.0


def test_empty_level_chisq(spark):
    groups = ["a", "b"]
    df = spark.createDataFrame([("a", "u"), ("a", "v"), ("b", "u"), ("b", "u"), ("a", "u"), ("b", "v")], "menopause_group string, c string")
    counts = D.categorical_levels(df, ["c"], {"c": ("u", "v", "w")}, groups)
    real = D.chisq_stats(counts, groups, emulate_empty_levels=False).first()
    assert real["df"] == 1 and real["chi_square"] is not None
    emu = D.chisq_stats(counts, groups).first()
    assert emu["chi_square"] is None
    lv = {r["level"]: r for r in D.smd_categorical(counts, groups).collect()}
    assert lv["w"]["level_pairwise_smd"] == 0.0 and lv["Missing"]["level_pairwise_smd"] == 0.0


def test_km_censor_counts_at_and_since_previous_event_time(spark):
    # censored at 1, event at 2, censored at 2, censored at 3, event at 4, censored at 5
    e = _events(spark, [(1, "C", 1.0, False), (2, "C", 2.0, True), (3, "C", 2.0, False), (4, "C", 3.0, False),
                        (5, "C", 4.0, True), (6, "C", 5.0, False)])
    km = sorted(R.km_curve(e).collect(), key=lambda r: r["followup_wave"])
    assert [r["followup_wave"] for r in km] == [0.0, 2.0, 4.0]  # no row for the censoring after the last event
    assert [r["n_risk"] for r in km] == [6, 5, 2]
    assert [r["n_event"] for r in km] == [0, 1, 1]
    assert [r["n_censor"] for r in km] == [0, 1, 0]  # at the event time itself
    assert [r["n_censor_since_previous"] for r in km] == [0, 2, 1]  # (previous event time, event time]
    assert [r["retention_probability"] for r in km] == [1.0, 0.8, 0.4]
