"""Run queries against their SQL and report differences: python tests/check_oracles.py [sf_dir] [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> str:
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"ran, {len(got)} rows (no SQL)"
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    want_cols, want = rows_of(columns, rel.fetchall())
    if got_cols != want_cols:
        return f"FAIL columns {got_cols} != {want_cols}"
    if got != want:
        a, b = set(got), set(want)
        return (f"FAIL rows {len(got)} vs {len(want)}; only spark {sorted(a - b, key=repr)[:2]}; "
                f"only sql {sorted(b - a, key=repr)[:2]}")
    return f"ok, {len(got)} rows"


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            message = compare(spark, con, sf_dir, name, fn, sql.get(name))
        except Exception as e:
            message = "FAIL " + f"{type(e).__name__}: {e}"[:700]
        bad += message.startswith("FAIL")
        print(f"{name:24} {time.time() - start:6.1f}s  {message}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
