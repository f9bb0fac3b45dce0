"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return repr(value)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return normalise(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return normalise([d[0] for d in cursor.description], cursor.fetchall())


DUCK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def schema_mismatch(con, sql, df):
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    spark = {name: DUCK_TYPES.get(kind, kind) for name, kind in df.dtypes}
    return {n: (spark.get(n), duck.get(n)) for n in spark.keys() | duck.keys() if spark.get(n) != duck.get(n)}
