"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return rows_by_name(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_by_name(columns, cursor.fetchall())
