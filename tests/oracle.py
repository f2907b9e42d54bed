"""Compare a Spark result with a SQL result of the same tables, as bags of rows."""

from __future__ import annotations

import collections
import datetime
import decimal
import glob
import os

import duckdb


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def sql_bag(sf_dir: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    return sorted(columns), dict(zip(columns, types)), bag(columns, result.fetchall())


def spark_bag(df):
    return sorted(df.columns), dict(df.dtypes), bag(df.columns, [tuple(r) for r in df.collect()])


SAME_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}
