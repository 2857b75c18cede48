"""Records and their faults against Python's csv module and a one-pass reader."""

import csv
import io
import os
import tempfile
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from wavecohort.sources import csv_records as R
from wavecohort.sources import panel as P

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])


def folder(files):
    d = tempfile.mkdtemp(prefix="wavecohort-csv-")
    for name, text in files.items():
        with open(os.path.join(d, name), "w", newline="") as f:
            f.write(text)
    return d


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    previous = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, previous)


def faults(spark, d, **more):
    return sorted(((r["file"], r["row"], r["col"] or "", r["actual"]) for r in P.parse_diagnostics(spark, d, SCHEMA, **more).collect()))


def test_short_long_and_unused_columns(spark):
    d = folder({"x.csv": "a,c,b\n2,a\n3\n2,a,3,4\n,,\n5,ok,1\n"})
    assert faults(spark, d) == [("x.csv", 1, "", "2 columns"), ("x.csv", 2, "", "1 columns"), ("x.csv", 3, "", "4 columns")]


def test_quotes_and_lines(spark):
    text = 'a,b,c\n1,2,"x, y"\n2,"3","he said ""no"", twice"\n3,z,"two\nlines, ""here""\n\nand more"\n\n4,5,it\'s 5" long\n"6",7,"open\nb",8\nq,"NA",""\n'
    want = [("x.csv", 3, "b", "z"), ("x.csv", 5, "", "4 columns"), ("x.csv", 6, "a", "q")]
    assert faults(spark, folder({"x.csv": text})) == want


def test_every_split_size(spark, small_splits):
    body = "".join(f'{i},{"bad" if i % 7 == 0 else 1.5},"cell {i}' + ("\n,,\n\"\"" if i % 3 == 0 else "") + '"\n' + ("\n" if i % 11 == 0 else "") for i in range(1, 60))
    d = folder({"x.csv": "a,b,c\n" + body, "y.csv": "a,b,c\n" + body})
    want = [(f, i, "b", "bad") for f in ("x.csv", "y.csv") for i in range(7, 60, 7)]
    for n in (40, 97, 333, 5000):
        small_splits(n)
        assert faults(spark, d) == want
        assert R.read_records(spark, d).where("a is not null").count() == 2 * 59


def test_unclosed_and_too_long(spark, small_splits):
    d = folder({"x.csv": 'a,b,c\n1,2,"' + "line\n" * 40 + '"\nx,1,fine\n3,4,"never closed\n5,z,6\n7,8\n'})
    small_splits(50)
    want = [("x.csv", 1, "", "206 characters"), ("x.csv", 2, "a", "x"), ("x.csv", 3, "", "end of file")]
    assert faults(spark, d, longest=100) == [("x.csv", 1, "", "206 characters") if r[1] == 1 else r for r in want]
    assert faults(spark, d) == want[1:]


def test_headers_and_empty_files(spark):
    d = folder({"a.csv": "a,b,c\n1,2,3\n", "b.csv": "a,c\n1,2,3\n", "c.csv": "", "d.csv": "\n\n", "e.csv": "a,b,c"})
    assert faults(spark, d) == [("b.csv", 0, "", "a,c")]
    assert faults(spark, folder({"a.csv": ""})) == []


CELLS = st.lists(st.lists(st.text(alphabet='ab1,"\n \'', max_size=6), min_size=3, max_size=3), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(CELLS, st.integers(8, 60))
def test_records_equal_the_csv_module(spark, small_splits, rows, size):
    out = io.StringIO(newline="")
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n")
    writer.writerows([["a", "b", "c"], *rows])
    d = folder({"x.csv": out.getvalue()})
    small_splits(size)
    got = Counter(tuple(r) for r in R.read_records(spark, d).collect())
    assert got == Counter(tuple(None if c in ("", "NA") else c for c in r) for r in rows)


def test_lines_are_not_collected_by_file(spark):
    """Clean files are checked without a shuffle of their lines."""
    d = folder({f"{i}.csv": "a,b,c\n" + "1,2,3\n" * 50 for i in range(3)})
    records = R.Records(spark, d)
    assert records.mixed.count() == 0
    assert records.names == ["a", "b", "c"]


def test_a_record_is_cut_once_however_many_columns_are_checked(spark):
    """The tests of all columns read the same cells, and no filter cuts a record again."""
    lines = spark.createDataFrame([(1, "1,x"), (2, "1,2"), (3, "1")], "k int, value string")
    names = [f"c{i}" for i in range(2)]
    tests = {n: ("int", lambda c: c.try_cast("int")) for n in names}
    found = R.with_faults(lines, names, tests)
    assert sorted((r["k"], r["_fault"]["actual"]) for r in found.collect()) == [(1, "x"), (3, "1 columns")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
