"""Compare a query with its SQL in DuckDB."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(directory):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{directory}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql):
    """Empty text when equal, else what differs."""
    got_columns = spark_df.columns
    got = rows_of(got_columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_columns = [c[0] for c in cursor.description]
    want_types = {c[0]: str(c[1]) for c in cursor.description}
    want = rows_of(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    }
    for name, kind in spark_df.dtypes:
        if kinds.get(kind) != want_types[name]:
            return f"type of {name}: {kind} != {want_types[name]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(got_columns)}\n got {g}\nwant {w}"
    return ""
