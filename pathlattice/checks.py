"""Compare a Spark result with its DuckDB twin: same columns, same row multiset (test support)."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)


def compare(df, con, sql) -> tuple[bool, str]:
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duckdb={dc}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duckdb={len(dr)}"
    if sr != dr:
        bad = next(i for i, (a, b) in enumerate(zip(sr, dr)) if a != b)
        return False, f"values differ at sorted row {bad}: spark={sr[bad]} duckdb={dr[bad]}"
    return True, f"{len(sr)} rows equal"
