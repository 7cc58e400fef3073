"""Compare a Spark result with the SQL result of another engine, as row multisets."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import datetime

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(frame, con, sql: str) -> tuple[int, str]:
    """Row count and a description of the differences, empty if there are none."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(frame.columns):
        return 0, f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = _rows(names, expected.fetchall())
    got = _rows(frame.columns, frame.collect())
    extra, lacking = got - want, want - got
    problem = ""
    if extra or lacking:
        problem = (
            f"{sum(extra.values())} extra, {sum(lacking.values())} lacking: "
            f"{list(extra)[:3]} / {list(lacking)[:3]}"
        )
    return sum(got.values()), problem
