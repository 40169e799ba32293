"""Compare a Spark query with its DuckDB oracle: names, types, rows (as a multiset)."""

from __future__ import annotations

import math
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        if v == 0.0:
            v = 0.0
        return (1, repr(v))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    if isinstance(v, bool):
        return (1, str(int(v)))
    return (1, str(v))


_SPARK_TO_DUCK = {
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _kind(type_name: str) -> str:
    """Exact type, in DuckDB's naming (Spark names are mapped)."""
    return _SPARK_TO_DUCK.get(type_name, type_name.upper())


def compare(spark, sf_dir: str, name: str, query, sql: str) -> tuple[bool, str]:
    sdf = query(spark, sf_dir)
    s_types = {f.name: _kind(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: _kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if bad_types:
        return False, f"types differ: {bad_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    order = sorted(s_cols)
    s_idx = [s_cols.index(c) for c in order]
    d_idx = [d_cols.index(c) for c in order]
    s_set = sorted(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
    d_set = sorted(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
    if s_set != d_set:
        diff = [(a, b) for a, b in zip(s_set, d_set) if a != b][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import time

    import __spark_entry__ as E
    from rateforge.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    names = sys.argv[1:] or list(qs)
    failed = 0
    for n in names:
        t = time.time()
        if n not in sqls:
            rows = qs[n](spark, sf).count()
            print(f"{n}: rows-only {rows} rows ({time.time() - t:.1f}s)")
            continue
        try:
            ok, msg = compare(spark, sf, n, qs[n], sqls[n])
        except Exception as e:  # report and go on with the next query
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        failed += not ok
        print(f"{n}: {'OK' if ok else 'FAIL'} {msg} ({time.time() - t:.1f}s)")
    print(f"failed: {failed}")
