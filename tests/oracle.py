"""Compare registered Spark queries with their DuckDB oracles (test helper).

Usage: ``python tests/oracle.py [sf_dir] [query ...]``. Results are compared
as multisets of rows with columns sorted by name, plus the column names.
Collecting results is fine here: the fixtures are small test data.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark, con, name, query, sql, sf_dir):
    t = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in sdf.collect()])
    spark_s = time.time() - t
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = rows_of(d_cols, cur.fetchall())
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns {s_cols} vs {d_cols}")
    if s_cols != d_cols:
        problems.append("column order differs")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} vs {len(d_rows)}")
    elif Counter(s_rows) != Counter(d_rows):
        diff = (Counter(s_rows) - Counter(d_rows))
        problems.append(f"values differ, e.g. {list(diff)[:2]}")
    return len(s_rows), spark_s, problems


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from lodestar.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, oracles = queries(), oracle_sql()
    bad = 0
    for name in names:
        if name not in oracles:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:28s} rows={n:8d} (no oracle)")
            continue
        n, secs, problems = compare(spark, con, name, qs[name], oracles[name], sf_dir)
        bad += bool(problems)
        print(f"{name:28s} rows={n:8d} {secs:6.2f}s {'OK' if not problems else problems}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
