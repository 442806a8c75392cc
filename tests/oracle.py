"""Run registered queries next to their check SQL and compare the rows.

``python -m tests.oracle [--sf 0.01] [name ...]``
"""

from __future__ import annotations

import argparse
import datetime
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from tradeloom.catalog import REGISTRY
from tradeloom.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
ROOT = Path("/root/testdata")


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, Decimal):
        return ("decimal", v.normalize())
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), [names[i] for i in order]


def compare(spark, con, name: str, folder: str) -> tuple[str | None, int, float, float]:
    """(difference or None, rows, seconds in Spark, seconds in SQL)."""
    entry = REGISTRY[name]
    t0 = time.time()
    df = entry(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if any(w in plan for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")):
        return f"plan has pairs or Python: {plan[:300]}", 0, 0.0, 0.0
    got = df.collect()
    t1 = time.time()
    if entry.sql is None:
        return None, len(got), t1 - t0, 0.0
    cur = con.execute(entry.sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    t2 = time.time()
    a, an = sorted_rows(got, df.columns)
    b, bn = sorted_rows(want, names)
    if an != bn:
        return f"columns {an} / {bn}", len(got), t1 - t0, t2 - t1
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}: {a[:2]} / {b[:2]}", len(got), t1 - t0, t2 - t1
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{x} / {y}", len(got), t1 - t0, t2 - t1
    return None, len(got), t1 - t0, t2 - t1


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    folder = str(ROOT / f"sf{args.sf}")
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name in args.names or list(REGISTRY):
        try:
            diff, rows, s1, s2 = compare(spark, con, name, folder)
        except Exception as e:  # noqa: BLE001
            diff, rows, s1, s2 = "ERROR " + str(e).split("JVM stacktrace")[0][:600], 0, 0, 0
        bad += diff is not None
        kind = "sql" if REGISTRY[name].sql else "rows"
        print(f"{'FAIL' if diff else 'ok':4} {kind:4} {name:34} {rows:7} rows {s1:6.2f}s {s2:6.2f}s {diff or ''}", flush=True)
    print(f"{bad} failed")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
