"""Compare a Spark result with its SQL: columns, types and the multiset of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """What differs; empty when both agree."""
    result = connection.execute(sql)
    duck_names = [c[0] for c in result.description]
    duck_types = {c[0]: _DUCK_TYPES.get(str(c[1]).upper(), str(c[1])) for c in result.description}
    duck = _rows(duck_names, result.fetchall())
    spark_types = dict(df.dtypes)
    spark = _rows(df.columns, df.collect())
    out = []
    if sorted(df.columns) != sorted(duck_names):
        out.append(f"columns {sorted(df.columns)} / {sorted(duck_names)}")
    elif spark_types != duck_types:
        out.append(f"types {({c: (spark_types[c], duck_types[c]) for c in spark_types if spark_types[c] != duck_types[c]})}")
    if spark != duck:
        left, right = spark - duck, duck - spark
        out.append(
            f"rows {sum(spark.values())} / {sum(duck.values())}; only Spark {list(left)[:2]}; only SQL {list(right)[:2]}"
        )
    return out
