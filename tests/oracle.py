"""Compare a registered query with its SQL on the same Parquet tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb

SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "float": "FLOAT",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, list):
        return repr([_cell(v) for v in value])
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences in names, types and values; empty when the results agree."""
    problems = []
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if SPARK_TO_SQL.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(names, expected)
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w][:3]
        problems.append(f"values differ, {sum(g != w for g, w in zip(got, want))} of {len(want)}: {str(bad)[:700]}")
    if not want:
        problems.append("no rows")
    return problems
