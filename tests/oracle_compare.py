"""Spark query against its DuckDB oracle on the same parquet tables:
row count, column names and order-insensitive values.

Run standalone: ``python -m tests.oracle_compare [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
import numpy as np

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "binary": "BLOB",
    "float": "FLOAT",
}


def _duck_type(spark_type: str) -> str:
    if spark_type.startswith("array<") and spark_type.endswith(">"):
        return _duck_type(spark_type[6:-1]) + "[]"
    return SPARK_TO_DUCK.get(spark_type, spark_type)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float | np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, np.bool_):
        return bool(v)
    if isinstance(v, dt.datetime | np.datetime64):
        return str(np.datetime64(v, "us"))
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bytes | bytearray | memoryview):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    rows.sort(key=repr)
    return [columns[i] for i in order], rows


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_records = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "spark_rows": len(s_records), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    t0 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_records = rel.fetchall()
    out["duck_rows"] = len(d_records)
    out["duck_sec"] = round(time.time() - t0, 2)
    sc, sr = _rows(s_cols, s_records)
    dc, dr = _rows(d_cols, d_records)
    s_types = {f.name: _duck_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    type_diffs = {c: (s_types[c], d_types.get(c)) for c in s_types if c in d_types and s_types[c] != d_types[c]}
    if sc != dc:
        out["status"] = f"COLUMNS differ: spark={sc} duck={dc}"
    elif type_diffs:
        out["status"] = f"TYPES differ: {type_diffs}"
    elif len(sr) != len(dr):
        out["status"] = "ROWCOUNT differs"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        out["status"] = f"VALUES differ, e.g. {diff}"
    else:
        out["status"] = "match"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from twinsift.registry import oracle_sql, queries
    from twinsift.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(queries())
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, qs[n], sqls.get(n), sf_dir, con)
        except Exception as e:  # report and go on with the next query
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        ok = r["status"] in ("match", "rows-only")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
