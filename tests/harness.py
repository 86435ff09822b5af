"""Run a query on Spark and its SQL on DuckDB and compare them as bags of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 9)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    raise TypeError(f"result columns must be plain values, got {type(value)}")


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = result.fetchall()
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(left: tuple[list[str], Counter], right: tuple[list[str], Counter]) -> str:
    """Empty if equal, else what differs."""
    if left[0] != right[0]:
        return f"columns differ: {left[0]} / {right[0]}"
    only_left, only_right = left[1] - right[1], right[1] - left[1]
    if only_left or only_right:
        return (
            f"{sum(left[1].values())} / {sum(right[1].values())} rows; "
            f"only left {sum(only_left.values())}: {list(only_left)[:2]}; "
            f"only right {sum(only_right.values())}: {list(only_right)[:2]}"
        )
    return ""
