"""Compares registered queries with their SQL: ``python tests/oracle_check.py [sf] [names...]``."""

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations""".split()


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def sql_rows(sf_dir, sql):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def compare(spark, name, sf_dir):
    """None when equal, else a description; and the row count."""
    df = entry.queries()[name](spark, sf_dir)
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, len(got)
    names, want = sql_rows(sf_dir, sql)
    if sorted(names) != sorted(got_names):
        return f"columns {sorted(got_names)} against {sorted(names)}", len(got)
    order = sorted(names)

    def bag(cols, rows):
        at = [list(cols).index(c) for c in order]
        return Counter(tuple(canonical(r[i]) for i in at) for r in rows)

    a, b = bag(got_names, got), bag(names, want)
    if a != b:
        return f"{len(got)} rows against {len(want)}; only here {list((a - b))[:2]}; only there {list((b - a))[:2]}", len(got)
    return None, len(got)


if __name__ == "__main__":
    from tidemark import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    session = build_session("check", master="local[8]", spark__sql__shuffle__partitions="8")
    session.sparkContext.setLogLevel("ERROR")
    for key in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem, n = compare(session, key, f"/root/testdata/sf{sf}")
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
