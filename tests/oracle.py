"""Compares a query with its SQL: same columns, same rows in any order."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb

TESTDATA = "/root/testdata"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_plain(row[i]) for i in order) for row in rows])


def spark_rows(df):
    return normalized(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    relation = connection.sql(sql)
    return normalized(relation.columns, relation.fetchall())
