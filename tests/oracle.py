"""Runs a catalogue query on Spark and its SQL twin on DuckDB and compares names, types and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp_ntz", "HUGEINT": "bigint"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, isinstance(v, float) and math.isnan(v), str(v)) for v in row)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in rel.description}
    expected_rows = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if dict(df.dtypes) != types:
        return f"types {sorted(set(df.dtypes) ^ set(types.items()))}"
    order = sorted(names)
    # -0.0 and 0.0 are one value.
    norm = lambda v: v + 0.0 if isinstance(v, float) else v
    got = sorted((tuple(norm(r[c]) for c in order) for r in df.select(order).collect()), key=_key)
    at = [names.index(c) for c in order]
    expected = sorted((tuple(norm(r[i]) for i in at) for r in expected_rows), key=_key)
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(bad)} rows differ, e.g. {order}\n  spark  {bad[0][0]}\n  duckdb {bad[0][1]}" if bad else None
