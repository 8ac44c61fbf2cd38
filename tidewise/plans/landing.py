"""The pipeline's stores, built from the test tables on first use and then read by the queries.

Topics hold JSON messages, the order tables typed rows, and the two document
tables what the daily-active and order jobs leave behind: the day-partitioned
data the published queries run on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dau, logs, orders
from ..schemas import (
    DAU_INFO,
    ORDER_DETAIL,
    ORDER_DETAIL_TOPIC,
    ORDER_INFO,
    ORDER_INFO_TOPIC,
    ORDER_WIDE_STORED,
    PAGE_DAY,
    PAGE_TOPIC,
    RAW_CDC_TOPIC,
    RAW_LOG_TOPIC,
    TOPIC_RECORD,
)
from ..session import scratch_dir
from ..sinks import days, postings, uv
from ..sinks.upsert import read_days, upsert
from ..sources import samples, tables
from ..sources.topics import land

Builder = Callable[[SparkSession, str, str], None]
#: Files of a landed topic or table, whatever its size: the test tables come in one row group, a topic has many partitions.
PIECES = 32
_BUILDERS: dict[str, Builder] = {}
_PATHS: dict[tuple[str, str, str], str] = {}


def path_of(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where a store lies; builds it if this application has not yet, or if it has been cleared away since."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PATHS or not _exists(spark, _PATHS[key]):
        path = scratch_dir(spark, name)
        _BUILDERS[name](spark, sf_dir, path)
        _PATHS[key] = path
    return _PATHS[key]


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def build_all(spark: SparkSession, sf_dir: str) -> None:
    for name in _BUILDERS:
        path_of(spark, sf_dir, name)


def _store(build: Builder) -> Builder:
    _BUILDERS[build.__name__.lstrip("_")] = build
    return build


@_store
def _raw_log(spark: SparkSession, sf: str, path: str) -> None:
    land(samples.raw_log_records(spark, sf, PIECES), RAW_LOG_TOPIC, path)


@_store
def _cdc(spark: SparkSession, sf: str, path: str) -> None:
    records = samples.cdc_records(spark, sf, PIECES)
    land(records.withColumn("timestamp", F.timestamp_seconds(F.lit(samples.EPOCH))), RAW_CDC_TOPIC, path)


@_store
def _page(spark: SparkSession, sf: str, path: str) -> None:
    messages = logs.fan_out(logs.parse_logs(topic(spark, sf, "raw_log"))).where(F.col("topic") == PAGE_TOPIC)
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    land(messages.withColumn("offset", ts).withColumn("timestamp", F.timestamp_millis(ts)), PAGE_TOPIC, path, pieces=PIECES)


@_store
def _page_days(spark: SparkSession, sf: str, path: str) -> None:
    pages = logs.page_log(logs.parse_logs(topic(spark, sf, "raw_log")))
    days.write_days(dau.with_day(pages).select(*PAGE_DAY.names), path, "log-0")


@_store
def _uv(spark: SparkSession, sf: str, path: str) -> None:
    uv.add_days(spark, path_of(spark, sf, "page_days"), path, days.days_up_to(samples.LAST_DAY, samples.PERIOD))


@_store
def _dims(spark: SparkSession, sf: str, path: str) -> None:
    for name, rows in (("user_info", samples.user_info(spark, sf)), ("base_province", samples.base_province(spark, sf))):
        images = rows.select(
            F.lit(name).alias("table_name"), F.col("id").cast("string").alias("id"), F.lit("I").alias("op"),
            F.to_json(F.struct(*rows.columns)).alias("data"), F.lit(samples.EPOCH).cast("long").alias("ts"),
        )
        upsert(images, path, "id", "table_name", f"{name}-0", version=("ts",), buckets=tables.DIM_BUCKETS)


@_store
def _order_info(spark: SparkSession, sf: str, path: str) -> None:
    samples.order_info(spark, sf, PIECES).write.parquet(path)


@_store
def _order_detail(spark: SparkSession, sf: str, path: str) -> None:
    samples.order_detail(spark, sf, PIECES).write.parquet(path)


@_store
def _order_repeats(spark: SparkSession, sf: str, path: str) -> None:
    """Ids of headers and of lines that come more than once, the lines they concern, and those lines' orders."""
    details = order_detail(spark, sf)
    for name, rows in (("headers", _headers(spark, sf)), ("lines", details)):
        orders.repeated(rows).write.parquet(f"{path}/{name}")
    headers, lines = (spark.read.schema("id LONG").parquet(f"{path}/{name}") for name in ("headers", "lines"))
    orders.to_compare(details, headers, lines).write.parquet(f"{path}/compared")
    compared = spark.read.schema(ORDER_DETAIL).parquet(f"{path}/compared")
    compared.select(F.col("order_id").alias("id")).distinct().write.parquet(f"{path}/orders")


@_store
def _order_info_topic(spark: SparkSession, sf: str, path: str) -> None:
    land(samples.as_messages(order_info(spark, sf), "id"), ORDER_INFO_TOPIC, path, pieces=PIECES)


@_store
def _order_detail_topic(spark: SparkSession, sf: str, path: str) -> None:
    land(samples.as_messages(order_detail(spark, sf), "order_id"), ORDER_DETAIL_TOPIC, path, pieces=PIECES)


@_store
def _dau_docs(spark: SparkSession, sf: str, path: str) -> None:
    pages = logs.page_log(logs.parse_logs(topic(spark, sf, "raw_log")))
    first = dau.first_seen(dau.with_day(dau.session_entries(pages)))
    users, provinces = samples.user_info(spark, sf), samples.base_province(spark, sf)
    upsert(dau.dau_wide(first, users, provinces, samples.AS_OF), path, "mid", "dt", "dau-0", order=("ts",))


@_store
def _order_docs(spark: SparkSession, sf: str, path: str) -> None:
    docs = order_wide(spark, sf).withColumn("dt", F.col("create_date")).select(*ORDER_WIDE_STORED.names)
    upsert(docs, path, "detail_id", "dt", "orders-0", order=("create_time",), unique=True)


@_store
def _postings(spark: SparkSession, sf: str, path: str) -> None:
    postings.add_days(order_docs(spark, sf, days.days_up_to(samples.ORDER_DAY, 10), "sku_name"), path)


def topic(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TOPIC_RECORD).parquet(path_of(spark, sf, name))


def order_info(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(ORDER_INFO).parquet(path_of(spark, sf, "order_info"))


def order_detail(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(ORDER_DETAIL).parquet(path_of(spark, sf, "order_detail"))


def _headers(spark: SparkSession, sf: str) -> DataFrame:
    """Order headers with user and province. A user of several rows makes several of a header."""
    users, provinces = samples.user_info(spark, sf), samples.base_province(spark, sf)
    return orders.order_info_wide(order_info(spark, sf), users, provinces, samples.AS_OF)


def order_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The order documents, computed from headers and lines."""
    infos = _headers(spark, sf)
    path = path_of(spark, sf, "order_repeats")
    headers, lines, their_orders = (spark.read.schema("id LONG").parquet(f"{path}/{name}") for name in ("headers", "lines", "orders"))
    compared = spark.read.schema(ORDER_DETAIL).parquet(f"{path}/compared")
    return orders.order_wide_apart(infos, order_detail(spark, sf), headers, lines, compared, their_orders)


def lookups(spark: SparkSession, sf: str):
    """Users and provinces for a batch of facts, from the stored dimensions."""
    path = path_of(spark, sf, "dims")
    return (lambda s, ids: tables.users(s, path, ids)), (lambda s, ids: tables.provinces(s, path, ids))


def page_days(spark: SparkSession, sf: str, of: list[str]) -> DataFrame:
    """The stored page records of some days."""
    return days.read_days(spark, path_of(spark, sf, "page_days"), PAGE_DAY, of)


def device_bitmaps(spark: SparkSession, sf: str, of: list[str]) -> DataFrame:
    """The devices of some days as bitmaps."""
    return uv.bitmaps(spark, path_of(spark, sf, "uv"), of)


def dau_docs(spark: SparkSession, sf: str, of: list[str], *columns: str) -> DataFrame:
    """The stored daily-active documents of some days, narrowed to the columns a query needs."""
    return read_days(spark, path_of(spark, sf, "dau_docs"), DAU_INFO, "mid", "dt", of, columns)


def order_docs(spark: SparkSession, sf: str, of: list[str], *columns: str) -> DataFrame:
    """The stored order documents of some days, narrowed to the columns a query needs."""
    return read_days(spark, path_of(spark, sf, "order_docs"), ORDER_WIDE_STORED, "detail_id", "dt", of, columns)
