"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

import math
from pathlib import Path

import duckdb

TABLES = Path("/root/testdata")


def connection(sf_dir: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return "NULL" if value is None else str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def assert_same(frame, con, sql):
    relation = con.sql(sql)
    assert sorted(frame.columns) == sorted(relation.columns)
    actual = as_rows(frame.columns, frame.collect())
    expected = as_rows(relation.columns, relation.fetchall())
    assert len(actual) == len(expected)
    assert actual == expected
