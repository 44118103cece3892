"""Compare every registered query with its DuckDB SQL.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return "None" if v is None else f"{type(v).__name__}:{v}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    """None if equal, else a short description of the first difference."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None


if __name__ == "__main__":
    import importlib

    from conftest import make_session

    entry = importlib.import_module("__spark_entry__")
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or qs:
        t = time.time()
        try:
            diff = compare(spark, con, sf, qs[name], sqls[name])
        except Exception as e:  # report and go on
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - t:.2f}s {diff or ''}",
              flush=True)
    print(f"{bad} differ; without SQL: {sorted(set(qs) - set(sqls))}; "
          f"SQL without query: {sorted(set(sqls) - set(qs))}")
