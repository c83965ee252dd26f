"""Compare a report with the SQL that states the same result."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark type -> the DuckDB types that hold the same values
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def differences(df, con, sql: str) -> list[str]:
    """An empty list when names, types and all values agree exactly."""
    rel = con.sql(sql)
    names, kinds = list(rel.columns), [str(x) for x in rel.types]
    got_names = df.columns
    problems = []
    if sorted(names) != sorted(got_names):
        return [f"columns {sorted(got_names)} != {sorted(names)}"]
    want_kind = dict(zip(names, kinds))
    for name, kind in df.dtypes:
        if want_kind[name] not in SAME_TYPE.get(kind, {kind}):
            problems.append(f"type of {name}: {kind} != {want_kind[name]}")
    got = _rows([tuple(r) for r in df.collect()], got_names)
    want = _rows(rel.fetchall(), names)
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {bad[0]}")
    if not want:
        problems.append("the expected result is empty, so nothing is checked")
    return problems
