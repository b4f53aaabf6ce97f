"""Run a registered query and its SQL twin on the same tables and compare them."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float):
        return value + 0.0  # -0.0 and 0.0 are one value
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


# How the two sides name the same types.
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def rows_of_spark(df):
    names = sorted(df.columns)
    types = dict(df.dtypes)
    return [(n, SQL_TYPES.get(types[n], types[n])) for n in names], sorted((tuple(_cell(r[n]) for n in names) for r in df.collect()), key=_key)


def rows_of_sql(con, text):
    result = con.execute(text)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = [tuple(_cell(r[i]) for i in order) for r in result.fetchall()]
    return [(columns[i], str(result.description[i][1])) for i in order], sorted(rows, key=_key)


def difference(spark_side, sql_side) -> str | None:
    (a_names, a), (b_names, b) = spark_side, sql_side
    if a_names != b_names:
        return f"columns {a_names} != {b_names}"
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
