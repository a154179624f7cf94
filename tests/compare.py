"""Order-insensitive comparison of a Spark result with DuckDB's."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duckdb_connection(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _sortable(value):
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "NaN")
    return (2, repr(value))


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple(map(_sortable, row)))


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def compare(spark_df, connection, sql):
    """None when equal, else a description of the first difference."""
    relation = connection.sql(sql)
    columns = relation.columns
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    spark_types = dict(spark_df.dtypes)
    duck_types = {c: KINDS.get(str(t), str(t)) for c, t in zip(columns, relation.types)}
    if spark_types != duck_types:
        return f"types differ: { {c: (spark_types[c], duck_types[c]) for c in columns if spark_types[c] != duck_types[c]} }"
    expected = normal_rows(columns, relation.fetchall())
    actual = normal_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(expected) != len(actual):
        return f"{len(actual)} rows, expected {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(different)} rows differ, first {different[0]}" if different else None
