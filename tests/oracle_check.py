"""Run registered queries in Spark and their SQL in DuckDB; compare like
the driver does (row count, schema, order-insensitive value hash).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if STRICT else repr(round(v, 6))
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


SPARK2DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from wavecohort.session import local_session

    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:800]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sqls[name])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
            dtypes = [str(d[1]) for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:800]}")
            bad += 1
            continue
        problems = []
        if sorted(scols) != sorted(dcols):
            problems.append(f"cols spark-only={sorted(set(scols) - set(dcols))} duck-only={sorted(set(dcols) - set(scols))}")
        else:
            st = dict(zip(scols, stypes))
            dt = dict(zip(dcols, dtypes))
            tm = [f"{c}:{st[c]}/{dt[c]}" for c in scols if SPARK2DUCK.get(st[c], st[c]) != dt[c]]
            if tm:
                problems.append("types " + ", ".join(tm))
        if len(srows) != len(drows):
            problems.append(f"rows {len(srows)} vs {len(drows)}")
        if not problems or problems[0].startswith("types"):
            hs, ls = digest(srows, scols)
            hd, ld = digest(drows, dcols)
            if hs != hd:
                diff_s = [x for x in ls if x not in set(ld)][:3]
                diff_d = [x for x in ld if x not in set(ls)][:3]
                problems.append(f"values differ; spark-only {diff_s} duck-only {diff_d}")
        if problems:
            bad += 1
            print(f"FAIL {name}: " + "; ".join(problems))
        else:
            print(f"OK   {name}: {len(srows)} rows ({ts:.1f}s)")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
