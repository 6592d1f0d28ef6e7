"""Order-free comparison of a Spark frame with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_KIND = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "array<string>": "VARCHAR[]", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(str(_plain(v)) for v in value) + "]"
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return None if value is None else str(value)


def _sorted(rows, order):
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, v or "") for v in r))


def diff(frame, con, sql: str) -> list[str]:
    """Differences as text; empty when rows, names and types agree."""
    relation = con.sql(sql)
    names = sorted(frame.columns)
    problems = []
    if names != sorted(relation.columns):
        return [f"columns: {names} / {sorted(relation.columns)}"]
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    other = dict(zip(relation.columns, map(str, relation.types)))
    for name in names:
        if _KIND.get(kinds[name], kinds[name]) != other[name]:
            problems.append(f"type of {name}: {kinds[name]} / {other[name]}")
    mine = _sorted(frame.collect(), [frame.columns.index(n) for n in names])
    theirs = _sorted(relation.fetchall(), [relation.columns.index(n) for n in names])
    if len(mine) != len(theirs):
        problems.append(f"rows: {len(mine)} / {len(theirs)}")
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        problems.append(f"{names}: {len(bad)} rows differ, first {bad[0]}")
    return problems
