"""Compares a query with its SQL on the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB types and the Spark types they must meet.
SAME_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), 0 if v is None else v) for v in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: columns, types, row count, values. Empty if nothing does."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {n: str(t) for n, t in zip(names, [d[1] for d in result.description])}
    expected = result.fetchall()
    order = sorted(df.columns)
    if sorted(names) != order:
        return [f"columns {sorted(names)} != {order}"]
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    problems = [
        f"type of {n}: {types[n]} != {spark_types[n]}" for n in order if SAME_TYPE.get(types[n]) != spark_types[n]
    ]
    got = [tuple(_plain(r[c]) for c in order) for r in df.collect()]
    place = [names.index(c) for c in order]
    want = [tuple(_plain(r[i]) for i in place) for r in expected]
    if len(got) != len(want):
        return [*problems, f"rows: {len(want)} wanted, {len(got)} got"]
    got.sort(key=_key)
    want.sort(key=_key)
    wrong = [(w, g) for w, g in zip(want, got) if w != g]
    if wrong:
        problems.append(f"{len(wrong)} of {len(want)} rows differ, first: {wrong[0]}")
    return problems
