"""Compare a query's rows with its SQL, without regard to order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    """One form for values that both engines give in different Python types."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        raise TypeError("give decimals as double or text")
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        raise TypeError("give dates as text")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql):
    """None when equal, else a short text."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    wanted = rows_of(names, expected.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(found) != len(wanted):
        return f"{len(found)} rows against {len(wanted)}"
    for a, b in zip(found, wanted):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"found {a}, wanted {b}"
    return None
