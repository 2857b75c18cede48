"""Benchmark: the whole analysis on the panel derived from ``orders``.

One session and one Study, as a user runs it: every registered result is
built and collected in pipeline order; the first result that needs a stage
pays for it (stages are checkpointed once). Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from wavecohort.plans import registry  # noqa: E402
from wavecohort.plans.study import Study  # noqa: E402
from wavecohort.session import configure  # noqa: E402

HEADLINE = [
    "panel_scan", "temporal_order", "invariant_diag", "mode_resolve", "status_sequence", "missingness_person",
    "integrity_flags", "integrity_cascade", "cohort_flags", "exclusion_cascade", "analytic_panel", "cohort_summary",
    "table1", "smd_diagnostics", "km_curve", "retention_by_wave", "ipcw_panel", "ipcw_models", "weight_summary",
    "lmm_fixed", "lmm_sensitivity", "sensitivity_wide", "marginal_means", "clinical_contrasts", "trajectories",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="wavecohort-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wavecohort-bench")
        .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    configure(spark)
    names = [n for n in HEADLINE if n in registry.BUILDERS]
    t_all = time.time()
    study = Study.from_orders(spark, sf_dir)
    times, rows, errors = {}, {}, {}
    for name in names:
        t = time.time()
        try:
            rows[name] = len(registry.BUILDERS[name](study).collect())
        except Exception as e:  # noqa: BLE001 - report and go on; the JSON line must print
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        times[name] = round(time.time() - t, 3)
    total = round(time.time() - t_all, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "full_analysis_wall_time", "value": total, "unit": "sec", "queries": times,
           "rows": rows, "sf": sf, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
