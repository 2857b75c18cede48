import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from wavecohort.session import configure

    s = (
        SparkSession.builder.master("local[4]")
        .appName("wavecohort-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wavecohort-test-ckpt-"))
    configure(s)
    yield s


DEFAULTS = dict(
    year=2000, agey_e=60.0, cogtot27_imp=20.0, cogfunction=1, Female=1, ragender=2, meno_combo="4.50-55 Natural (ref)",
    meno_type="Natural", meno_age5="4", meno_status_time="Postmenopausal", C253_age=50.0, C253_major_inconsistency=0,
    rabyear=1940, raedyrs=12, raeduc=3, raracem=1, rahispan=0,
)


def make_panel(spark, rows):
    """Hand fixture: dicts with hhidpn, wave and any overrides."""
    from wavecohort.sources.panel import PANEL_SCHEMA

    full = []
    for r in rows:
        d = dict(DEFAULTS)
        d.update(r)
        full.append(tuple(d.get(f.name) for f in PANEL_SCHEMA.fields))
    return spark.createDataFrame(full, PANEL_SCHEMA).repartition("hhidpn")


@pytest.fixture
def panel_of(spark):
    return lambda rows: make_panel(spark, rows)
