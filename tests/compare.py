"""Run a query in Spark and in DuckDB and compare the rows."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return (0, str(value))
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, int):
        return (1, repr(float(value)))
    return (2, str(value))


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return normalised(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return normalised(columns, cursor.fetchall())
