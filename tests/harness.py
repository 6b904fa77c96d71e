"""Compares registered queries with their SQL twins, as sorted columns and rows."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (repr(float(v)) if v != int(v) or abs(v) > 1e15 else repr(float(v))) if math.isfinite(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, folder):
    """None when equal, else a description of the first difference."""
    df = fn(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{[c for c in sorted(cols)]}\n  spark {g}\n  sql   {w}"
    return None


def session(shuffle=8):
    from trialweave.plans.session import build_session

    import tempfile

    folder = tempfile.mkdtemp(prefix="trialweave-tests-")
    spark = build_session("check", "local[8]", shuffle, memory=os.environ.get("CHECK_MEMORY", "8g"), scratch=folder)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as entry

    folder = os.environ.get("SF", "/root/testdata/sf0.01")
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = [n for n in qs if not argv or any(n.startswith(a) for a in argv)]
    spark, con = session(), duck(folder)
    bad = 0
    for n in names:
        t = time.time()
        try:
            if n in sqls:
                diff = compare(spark, con, n, qs[n], sqls[n], folder)
                state = "ok" if diff is None else f"DIFF {diff[:1500]}"
            else:
                state = f"rows {len(qs[n](spark, folder).collect())}"
        except Exception as e:  # report and go on
            state = f"ERROR {type(e).__name__} {str(e)[:1200]}"
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{n}: {time.time() - t:.1f}s {state}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
