"""Run a registered query and its SQL and compare the rows without regard to their order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _key(row) -> list:
    return [(v is None, str(type(v)), repr(v)) for v in row]


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def differences(got_columns, got_rows, want_columns, want_rows) -> str | None:
    """None where both tables agree, otherwise a description of the first difference."""
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    names = sorted(got_columns)
    got = sorted(([_plain(r[got_columns.index(c)]) for c in names] for r in got_rows), key=_key)
    want = sorted(([_plain(r[want_columns.index(c)]) for c in names] for r in want_rows), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for a, b in zip(got, want):
        if a != b:
            return f"{names}: {a} != {b}"
    return None


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def check(spark, db, run, sql: str, sf_dir: str) -> str | None:
    frame = run(spark, sf_dir)
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    problem = differences(frame.columns, [tuple(r) for r in frame.collect()], columns, result.fetchall())
    if problem:
        return problem
    for name, kind in frame.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    return None
