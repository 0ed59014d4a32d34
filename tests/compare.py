"""Comparing a registered query with its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def sql_result(sf_dir: str, sql: str):
    with duckdb.connect() as db:
        for file in Path(sf_dir).glob("*.parquet"):
            db.execute(f"create view {file.stem} as select * from '{file}'")
        cursor = db.execute(sql)
        columns = [d[0] for d in cursor.description]
        return sorted_rows(columns, cursor.fetchall())


def spark_result(df):
    return sorted_rows(df.columns, [tuple(row) for row in df.collect()])
