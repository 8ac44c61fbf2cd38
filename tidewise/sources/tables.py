"""Stored tables: config lists and dimension snapshots, read anew wherever a batch needs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import typed_dim
from ..schemas import DIM_ROW, PROVINCE_DIM, TABLE_LIST, USER_DIM
from ..sinks.upsert import read_current, read_or_empty


#: Parts of a dimension table by a hash of the id: a batch of few ids opens as many folders at most.
DIM_BUCKETS = 64


def table_lists(spark: SparkSession, path: str) -> DataFrame:
    """The fact and dimension table lists as they are now. Read it inside the batch, so an edit counts from the next one.

    A job that routes by lists should find them: see ``required_lists``.
    """
    return read_or_empty(spark, path, TABLE_LIST)


def required_lists(spark: SparkSession, path: str) -> DataFrame:
    """The same, but a path that does not exist fails the batch instead of routing nothing; an empty list is fine."""
    return spark.read.schema(TABLE_LIST).parquet(path)


def current_dim(
    spark: SparkSession,
    path: str,
    table: str,
    schema: T.StructType,
    ids: DataFrame | None = None,
    drop_deleted: bool = False,
) -> DataFrame:
    """One dimension table from the stored images; the table name prunes the folders read.

    ``ids`` (one column ``id``) restricts it to the rows a batch of facts refers to.
    """
    only = ids.select(ids["id"].cast("string").alias("id")) if ids is not None else None
    rows = read_current(spark, path, DIM_ROW, "id", "table_name", only=only, values=[table], buckets=DIM_BUCKETS)
    return typed_dim(rows.where("op <> 'D'") if drop_deleted else rows, table, schema)


def users(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    return current_dim(spark, path, "user_info", USER_DIM, ids)


def provinces(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    return current_dim(spark, path, "base_province", PROVINCE_DIM, ids)
