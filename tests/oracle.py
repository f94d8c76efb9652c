"""Compare a query's rows with what DuckDB makes of its SQL."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

from acreage.plans.views import TABLE_NAMES

KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (datetime.date, decimal.Decimal, list, dict)):
        raise AssertionError(f"not a plain value: {value!r}")
    return value


def compare(df, sql: str, con: duckdb.DuckDBPyConnection) -> int:
    """Raise on any difference in columns, types or rows; returns the number of rows."""
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert sorted(described) == names, (sorted(described), names)
    differing = {n: (kinds[n], described[n]) for n in names if KINDS.get(kinds[n]) != described[n]}
    assert not differing, differing
    shown = ", ".join(f'"{n}"' for n in names)
    want = Counter(
        tuple(cell(v) for v in row) for row in con.execute(f"SELECT {shown} FROM ({sql})").fetchall()
    )
    got = Counter(tuple(cell(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if want != got:
        raise AssertionError(
            f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"unexpected {list((got - want).items())[:3]}; missing {list((want - got).items())[:3]}"
        )
    return sum(got.values())
