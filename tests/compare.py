"""Run registered queries in Spark and their SQL in DuckDB and compare the results as multisets of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    start = time.time()
    df = fn(spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return took, len(got_rows), None
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = rows_of(names, result.fetchall())
    got = rows_of(df.columns, got_rows)
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    elif got != want:
        g, w = set(got), set(want)
        problems.append(f"rows {len(got)} vs {len(want)}; only spark {sorted(g - w, key=repr)[:2]}; only sql {sorted(w - g, key=repr)[:2]}")
        problems.append(f"types {[type(x).__name__ for x in (got or [()])[0]]} vs {[type(x).__name__ for x in (want or [()])[0]]}")
    return took, len(got_rows), problems


def main():
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from paperloom.session import build_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and not any(o == name or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        try:
            took, n, problems = compare(spark, con, name, fn, sqls.get(name), sf_dir)
            state = "rows-only" if problems is None else ("ok" if not problems else "DIFF")
            print(f"{name:28s} {state:9s} {n:7d} rows {took:6.2f}s", flush=True)
            for p in problems or []:
                print("     ", str(p)[:1500], flush=True)
            bad += bool(problems)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERROR {str(e)[:700]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
