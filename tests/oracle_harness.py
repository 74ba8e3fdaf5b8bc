"""Compare each registered Spark query with its DuckDB oracle.

Usable from pytest (``tests/test_oracle.py``) and as a script:

    python tests/oracle_harness.py [sf_dir] [key ...]

Comparison: same column names (sorted), same row count, same multiset of
rows (values compared exactly after sorting columns by name).
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and v != v:
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


def type_mismatches(sdf, rel) -> list[str]:
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for name, t in sdf.dtypes:
        want = _TYPES.get(t, t)
        if duck_types.get(name) != want:
            out.append(f"{name}: spark {t} vs duck {duck_types.get(name)}")
    return out


def compare(spark, con, key: str, sf_dir: str) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = oracle_sql().get(key)
    if sql is None:
        return True, f"rows-only ({len(s_rows)} rows, {t1 - t0:.1f}s)"
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    bad_types = type_mismatches(sdf, rel)
    if bad_types:
        return False, f"types differ: {bad_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(x != y for x, y in zip(a, b))} rows), e.g. {diff}"
    return True, f"match ({len(s_rows)} rows, {t1 - t0:.1f}s)"


def main(argv):
    from selfmend.session import build_session
    from __spark_entry__ import queries
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            ok, msg = compare(spark, con, k, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {k:28s} {msg}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} passed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
