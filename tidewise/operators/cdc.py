"""Database change records: op codes, routing by table list, latest dimension image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import pick_one
from ..functions.scalars import op_code, table_topic
from ..schemas import CDC, CORRUPT_TOPIC
from .logs import parse_json

FACT_LIST = "FACT:TABLES"
DIM_LIST = "DIM:TABLES"


def parse_cdc(raw: DataFrame) -> DataFrame:
    return parse_json(raw, CDC).withColumn("ts", F.col("ts").try_cast("bigint"))


def changes(parsed: DataFrame) -> DataFrame:
    """Inserts, updates and deletes with their op code; every other change type is dropped."""
    return (
        parsed.where(F.col("_corrupt").isNull())
        .withColumn("op", op_code(F.col("type")))
        .where(F.col("op").isNotNull())
        .withColumn("id", F.get_json_object("data", "$.id"))
    )


def listed(table_lists: DataFrame, name: str) -> DataFrame:
    """Table names of one list. The lists name tables of one database; they do not grow with its rows."""
    return table_lists.where(F.col("list_name") == name).select(F.col("table_name").alias("table")).distinct()


def fact_messages(changed: DataFrame, table_lists: DataFrame) -> DataFrame:
    """Changes of the listed fact tables as (topic, key, value); the key keeps one row's changes in order."""
    return changed.join(listed(table_lists, FACT_LIST), "table", "left_semi").select(*_message())


def corrupt_messages(parsed: DataFrame) -> DataFrame:
    """Change records that could not be read, as they came, for the corrupt topic."""
    bad = parsed.where(F.col("_corrupt").isNotNull())
    return bad.select(F.lit(CORRUPT_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"), F.col("_corrupt").alias("value"))


def dim_rows(changed: DataFrame, table_lists: DataFrame) -> DataFrame:
    """Changes of the listed dimension tables. A table may be in both lists."""
    return changed.join(listed(table_lists, DIM_LIST), "table", "left_semi").select(*_dim_row(changed))


def _message() -> list[Column]:
    return [table_topic(F.col("table"), F.col("op")).alias("topic"), F.col("id").alias("key"), F.col("data").alias("value")]


def _dim_row(changed: DataFrame) -> list[Column]:
    position = [F.col("offset")] if "offset" in changed.columns else []
    return [F.col("table").alias("table_name"), "id", "op", "data", "ts", *position]


def route_counts(parsed: DataFrame, table_lists: DataFrame) -> DataFrame:
    """One row: records, and of those the unreadable ones, those that change no row, and those of tables in no list."""
    either = table_lists.select(F.col("table_name").alias("table"), F.lit(True).alias("_listed")).distinct()
    corrupt = F.col("_corrupt").isNotNull()
    no_change = ~corrupt & op_code(F.col("type")).isNull()
    unlisted = ~corrupt & op_code(F.col("type")).isNotNull() & F.col("_listed").isNull()
    return parsed.join(either, "table", "left").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(corrupt).alias("corrupt"),
        F.count_if(no_change).alias("no_change"),
        F.count_if(unlisted).alias("unlisted"),
    )


def latest_dim(rows: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """Last image per (table, id). A deleted row keeps its last image unless ``drop_deleted``."""
    order = [c for c in ("ts", "offset") if c in rows.columns]
    last = pick_one(rows, ["table_name", "id"], order, latest=True)
    return last.where(F.col("op") != "D") if drop_deleted else last


def typed_dim(dims: DataFrame, table: str, schema) -> DataFrame:
    """One dimension table with its own columns, from the stored images."""
    texts = ", ".join(f"{f.name} STRING" for f in schema)
    images = dims.where(F.col("table_name") == table).select(F.inline(F.array(F.from_json("data", texts))))
    return images.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])
