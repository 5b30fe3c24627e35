"""Comparing a Spark frame with a DuckDB result over the same tables."""

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE"}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(sf_dir) / table}.parquet'")
    return connection


def differences(df, connection, sql: str) -> list[str]:
    """What differs in columns, types or rows (as multisets, columns by name); empty when nothing does."""
    expected = connection.sql(sql)
    ours = {name: SPARK_TYPES[kind] for name, kind in df.dtypes}
    theirs = {name: str(kind) for name, kind in zip(expected.columns, expected.types)}
    if ours != theirs:
        return [f"schema {ours} != {theirs}"]
    columns = sorted(ours)
    got = Counter(map(tuple, df.select(*columns).collect()))
    wanted = Counter(expected.select(*[f'"{c}"' for c in columns]).fetchall())
    found = [] if wanted else ["no rows to compare"]
    if got.total() != wanted.total():
        found.append(f"{got.total()} rows != {wanted.total()}")
    if got != wanted:
        found.append(f"extra {list((got - wanted).items())[:3]}, missing {list((wanted - got).items())[:3]}")
    return found
