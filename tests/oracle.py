"""Compare registered queries with their SQL on the same Parquet files.

    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
DATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    """A value in a form both engines agree on, without blurring types that differ."""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return f"decimal:{v}"
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return f"tz:{v.astimezone(dt.timezone.utc).isoformat()}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(str, map(plain, v))) + "]"
    return str(v)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:3]
        only_want = sorted(set(want) - set(got))[:3]
        return False, f"rows {len(got)} vs {len(want)}\n   spark only {only_got}\n   sql only   {only_want}"
    return True, f"{len(got)} rows"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from chainmart import get_spark

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sf_dir = f"{DATA}/sf{args.sf}"
    spark = get_spark("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, qs, sqls = connect(sf_dir), queries(), oracle_sql()
    bad = 0
    for name in args.names or qs:
        t = time.time()
        try:
            if name in sqls:
                ok, note = compare(spark, con, name, qs[name], sqls[name], sf_dir)
            else:
                ok, note = True, f"{qs[name](spark, sf_dir).count()} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t:.1f}s {note}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
