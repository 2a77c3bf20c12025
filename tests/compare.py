"""Compares a Spark result with its SQL counterpart as multisets of rows."""

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return None if isinstance(value, float) and math.isnan(value) else float(f"{float(value):.10g}")
    return str(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def oracle_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), rows_of(df.columns, [tuple(row) for row in df.collect()])
