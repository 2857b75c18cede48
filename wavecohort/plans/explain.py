"""Print the physical plan of registered results.

    python -m wavecohort.plans.explain exclusion_cascade missing_panel [--sf /root/testdata/sf0.01]

Static plans (AQE off, no automatic broadcast) show the exchanges the
data layout needs; the stages upstream of a result appear as checkpoint
scans that keep the person partitioning.
"""

from __future__ import annotations

import argparse

from ..session import local_session
from . import registry


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="+")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--adaptive", action="store_true", help="keep AQE and broadcast conversion on")
    args = ap.parse_args(argv)
    spark = local_session()
    study = registry.study_for(spark, args.sf)
    for name in args.names:
        df = registry.BUILDERS[name](study)
        if not args.adaptive:
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        print(f"==== {name}")
        df.explain("formatted")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


if __name__ == "__main__":
    main()
