"""Load contract: fallback names, required columns, keys, parse diagnostics."""

import os
import tempfile

import numpy as np
import pytest

from wavecohort.sources import panel as P


def _csv(text):
    d = tempfile.mkdtemp(prefix="wavecohort-csv-")
    path = os.path.join(d, "panel.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


HEADER = "hhidpn,wave,year,age_wave,cog27,cogfunction,Female,ragender,meno_combo,meno_type,meno_age5,meno_status_time,C253_age,rabyear,raedyrs,raeduc,raracem,rahispan"


def test_fallback_names_are_renamed(spark):
    path = _csv(HEADER + "\n1,1,2000,60,20,1,1,2,6.Surgical,Surgical,4,Postmenopausal,50,1940,12,3,1,0\n")
    df = P.read_panel(spark, path)
    assert "agey_e" in df.columns and "cogtot27_imp" in df.columns
    assert df.first()["agey_e"] == 60


def test_missing_column_stops(spark):
    path = _csv("hhidpn,wave\n1,1\n")
    with pytest.raises(P.MissingColumns):
        P.read_panel(spark, path)


def test_parse_diagnostics_reports_bad_cells(spark):
    path = _csv("hhidpn,wave,agey_e\n1,1,60\n2,x,61\n3,1,NA\n")
    d = P.parse_diagnostics(spark, path).collect()
    assert [(r["col"], r["actual"]) for r in d] == [("wave", "x")]


def test_duplicate_keys_and_null_ids(panel_of):
    p = panel_of([dict(hhidpn=1, wave=1), dict(hhidpn=1, wave=1), dict(hhidpn=2, wave=1)])
    row = P.check_keys(p).first()
    assert row["duplicate_keys"] == 1 and row["null_ids"] == 0
    with pytest.raises(ValueError):
        P.assert_keys(p)
    assert P.dedupe_first(p).count() == 2


def test_stage_roundtrip_and_guard(spark, panel_of):
    p = panel_of([dict(hhidpn=1, wave=1), dict(hhidpn=2, wave=1)])
    d = tempfile.mkdtemp(prefix="wavecohort-stage-")
    P.save_stage(p, os.path.join(d, "s"))
    assert P.load_stage(spark, os.path.join(d, "s")).count() == 2
    for absent in (os.path.join(d, "absent"), "file://" + os.path.join(d, "absent")):
        with pytest.raises(P.MissingStage):
            P.require_stage(spark, absent)
        with pytest.raises(P.MissingStage):
            P.load_stage(spark, absent)
    assert P.require_stage(spark, "file://" + os.path.join(d, "s", "manifest")).count() == 1


def test_a_stage_that_dies_leaves_the_former_version(spark, panel_of):
    from pyspark.sql import functions as F

    d = os.path.join(tempfile.mkdtemp(prefix="wavecohort-stage-"), "it's")
    before = spark.sql("show tables").count()
    first = panel_of([dict(hhidpn=i, wave=1) for i in range(20)])
    P.save_stage(first, d)
    dying = first.unionByName(first).withColumn("wave", F.when(F.col("hhidpn") == 13, F.raise_error(F.lit("lost")).cast("int")).otherwise(2))
    with pytest.raises(Exception, match="lost"):
        P.save_stage(dying, d)
    assert len(os.listdir(os.path.join(d, "versions"))) >= 1
    back = P.load_stage(spark, d, verify=True)
    assert back.count() == 20 and back.where("wave = 2").count() == 0
    P.save_stage(first.where("hhidpn < 5"), d)
    assert P.load_stage(spark, d, verify=True).count() == 5 and back.count() == 20  # an open reader keeps its version
    assert spark.sql("show tables").count() == before


def test_a_damaged_stage_is_noticed(spark, panel_of):
    d = os.path.join(tempfile.mkdtemp(prefix="wavecohort-stage-"), "s")
    P.save_stage(panel_of([dict(hhidpn=i, wave=1) for i in range(20)]), d)
    [version] = os.listdir(os.path.join(d, "versions"))
    part = next(f for f in sorted(os.listdir(os.path.join(d, "versions", version))) if f.startswith("part-"))
    os.remove(os.path.join(d, "versions", version, part))
    with pytest.raises(ValueError, match="manifest"):
        P.load_stage(spark, d, verify=True)


def test_reloaded_stage_plans_no_exchange(spark, panel_of):
    """One id holds a third of all rows."""
    p = panel_of([dict(hhidpn=1 if i % 3 == 0 else 100 + i, wave=i) for i in range(60)])
    d = tempfile.mkdtemp(prefix="wavecohort-stage-")
    P.save_stage(p, os.path.join(d, "s"), buckets=5)
    back = P.load_stage(spark, os.path.join(d, "s"))
    per_person = back.groupBy("hhidpn").count()
    assert "Exchange" not in per_person._jdf.queryExecution().executedPlan().toString()
    assert {r["hhidpn"]: r["count"] for r in per_person.collect()}[1] == 20


def test_csv_types_do_not_follow_the_data(spark):
    path = _csv(",".join(f.name for f in P.PANEL_SCHEMA.fields) + "\n" + ",".join(["7", "1.0"] + ["2"] * 17) + "\n")
    df = P.read_panel(spark, path)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in P.PANEL_SCHEMA.fields]
    assert df.first()["wave"] == 1 and df.first()["cogtot27_imp"] == 2.0


def test_repeated_keys_are_refused_on_load(spark):
    head = ",".join(f.name for f in P.PANEL_SCHEMA.fields)
    path = _csv(head + "\n" + "\n".join(",".join(["7", "1"] + ["2"] * 17) for _ in range(2)) + "\n")
    with pytest.raises(ValueError, match="duplicate"):
        P.read_panel(spark, path)
    assert P.read_panel(spark, path, dedupe="first").count() == 1
    assert P.read_panel(spark, path, dedupe="keep").count() == 2


def test_parse_diagnostics_number_rows_per_file_across_splits(spark):
    d = tempfile.mkdtemp(prefix="wavecohort-diag-")
    for name in ("a", "b", "c"):
        with open(os.path.join(d, name + ".csv"), "w") as f:
            f.write("hhidpn,wave,agey_e\n" + "".join(f"{i},{'x' if i in (2, 400) else 1},60\n" for i in range(1, 401)))
            f.write("9,1\n9,1,60,7\n")
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = sorted((r["file"], r["row"], r["col"] or "", r["actual"]) for r in P.parse_diagnostics(spark, d).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    want = [(2, "wave", "x"), (400, "wave", "x"), (401, "", "2 columns"), (402, "", "4 columns")]
    assert got == [(f"{n}.csv", *w) for n in "abc" for w in want]


def test_write_table_parquet_and_csv(spark, panel_of):
    p = panel_of([dict(hhidpn=1, wave=1), dict(hhidpn=2, wave=1, cogtot27_imp=None)])
    d = tempfile.mkdtemp(prefix="wavecohort-sink-")
    P.write_table(p, os.path.join(d, "pq"))
    P.write_table(p, os.path.join(d, "csv"), fmt="csv")
    assert spark.read.parquet(os.path.join(d, "pq")).count() == 2
    back = spark.read.option("header", True).option("nullValue", "NA").csv(os.path.join(d, "csv"))
    assert back.where("cogtot27_imp is null").count() == 1


def test_dedupe_is_an_aggregate(panel_of):
    p = panel_of([dict(hhidpn=1, wave=1, agey_e=61.0), dict(hhidpn=1, wave=1, agey_e=60.0), dict(hhidpn=1, wave=2)])
    d = P.dedupe_first(p, order="agey_e")
    rows = {r["wave"]: r for r in d.collect()}
    assert len(rows) == 2 and rows[1]["agey_e"] == 60.0
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_study_export(spark):
    from wavecohort.plans.study import Study

    s = Study.from_orders(spark, "/root/testdata/sf0.001")
    d = tempfile.mkdtemp(prefix="wavecohort-export-")
    names = s.export(d, ["exclusion_cascade", "km_curve", "table1"], fmt="csv")
    assert names == ["exclusion_cascade", "km_curve", "table1"]
    back = spark.read.option("header", True).csv(os.path.join(d, "exclusion_cascade"))
    assert back.count() == 6


def test_csv_source_end_to_end(spark):
    """The reference starts from a CSV extract: write the derived panel as
    CSV (R-style NA), read it back with read_panel and run the cohort and a
    model; results equal the in-memory path."""
    from wavecohort.plans.study import Study
    from wavecohort.sources.fixture import load_panel

    d = tempfile.mkdtemp(prefix="wavecohort-csv-panel-")
    path = os.path.join(d, "panel.csv")
    load_panel(spark, "/root/testdata/sf0.001").coalesce(1).write.option("header", True).option("nullValue", "NA").csv(path)
    panel = P.read_panel(spark, path, fmt="csv", schema=P.PANEL_SCHEMA)
    from_csv = Study(spark, panel)
    direct = Study.from_orders(spark, "/root/testdata/sf0.001")
    key = lambda rows: sorted(tuple(r) for r in rows)
    assert key(from_csv.exclusion_cascade.collect()) == key(direct.exclusion_cascade.collect())
    assert key(from_csv.missingness_summary.collect()) == key(direct.missingness_summary.collect())
    f1, f2 = from_csv.fit("Model 0"), direct.fit("Model 0")
    assert abs(f1.deviance - f2.deviance) < 1e-8 and np.allclose(f1.beta, f2.beta)
