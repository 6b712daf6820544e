"""Compare catalogue queries with their reference SQL. `python -m tests.oracle [dir] [name...]`"""

from __future__ import annotations

import datetime
import decimal

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (int, float)):
        f = float(v)
        return "nan" if math.isnan(f) else round(f, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(con, spark_df, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = rows_of(want_names, cur.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(want_names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first {got[:1]} vs {want[:1]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first: {bad[0]}" if bad else None


def main() -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf), entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start, took = time.time(), -1.0
        try:
            df = build(spark, sf)
            df.collect()
            took = time.time() - start
            if name in sqls:
                problem = compare(con, df, sqls[name])
                kind = "sql "
            else:
                problem, kind = (None if df.count() >= 0 else "?"), "rows"
        except Exception as e:  # noqa: BLE001
            problem, kind = f"{type(e).__name__}: {str(e)[:700]}", "err "
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {kind} {took:6.1f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
