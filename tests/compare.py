"""Run a registered query on Spark and its check SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def duck(folder: str):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    return normal(rel.columns, rel.fetchall())


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
              "boolean": "BOOLEAN", "date": "DATE"}


def type_gaps(df, con, sql):
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    return [
        (name, kind, duck_types.get(name))
        for name, kind in df.dtypes
        if TYPE_NAMES.get(kind, kind) != duck_types.get(name)
    ]
