"""Run registered queries next to their SQL twins on one scale directory and compare the rows.

usage: python tools/check_oracle.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from genomeloom import catalog  # noqa: E402
from genomeloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def cell(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return ("f", round(value, 6))
    if hasattr(value, "item"):
        return cell(value.item())
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(cell(r[i]) for i in order) for r in rows), key=repr
    )


def compare(spark, con, item, sf_dir):
    start = time.time()
    df = item.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if not item.sql:
        return "rows-only", len(got), took, ""
    cur = con.execute(item.sql)
    want_cols = [d[0] for d in cur.description]
    a_cols, a = rows_of(df.columns, got)
    b_cols, b = rows_of(want_cols, cur.fetchall())
    if a_cols != b_cols:
        return "COLUMNS", len(got), took, f"{a_cols} != {b_cols}"
    if len(a) != len(b):
        return "COUNT", len(got), took, f"{len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return "VALUES", len(got), took, f"\n     spark {x}\n     sql   {y}"
    return "ok", len(got), took, ""


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    spark = local_session(8, "check")
    bad = 0
    for name, item in catalog.load().items():
        if args and not any(name.startswith(p) for p in args):
            continue
        try:
            status, n, took, note = compare(spark, con, item, sf_dir)
        except Exception as error:  # report and go on
            status, n, took, note = "ERROR", 0, 0.0, str(error)[:900]
        bad += status not in ("ok", "rows-only")
        print(f"{status:10s} {name:32s} rows={n:<8d} {took:6.2f}s {note}", flush=True)
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
