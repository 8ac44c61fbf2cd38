"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import age_years, as_date
from ..functions.text import query_terms
from ..operators import cdc, dashboard, dau, dims, logs, orders, reports, sessions, uv
from ..schemas import (
    DAU_INFO,
    DIM_ROW,
    HOURLY_ACTIVES,
    ORDER_DETAIL_TOPIC,
    ORDER_INFO_TOPIC,
    ORDER_WIDE_STORED,
    PAGE_TOPIC,
    RAW_CDC_TOPIC,
    RAW_LOG_TOPIC,
)
from ..session import scratch_dir, stream_session
from ..sinks import postings
from ..sinks import upsert as table
from ..sinks.days import days_up_to, read_days
from ..sources import samples
from ..sources.samples import AS_OF, ITEM, ITEM_ONE_TERM, LAST_DAY, MISSING_DAY, ORDER_DAY, TD
from ..sources.tables import provinces, required_lists, users
from ..sources.topics import file_topic, land, topic_folder
from ..streaming import balance, jobs
from . import landing

Query = Callable[[SparkSession, str], DataFrame]
ONCE = {"availableNow": True}
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def utc(spark: SparkSession) -> None:
    """Dates and hours are formatted in the session time zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    utc(spark)
    return logs.parse_logs(landing.topic(spark, sf, "raw_log"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return logs.page_log(_parsed(spark, sf))


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return dau.with_day(dau.session_entries(_pages(spark, sf)))


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    utc(spark)
    return cdc.changes(cdc.parse_cdc(landing.topic(spark, sf, "cdc")))


def _hours(spark: SparkSession, sf: str, *days: str) -> DataFrame:
    utc(spark)
    return landing.dau_docs(spark, sf, list(days), "hr")


def _infos(spark: SparkSession, sf: str) -> DataFrame:
    utc(spark)
    return landing.order_info(spark, sf)


def _details(spark: SparkSession, sf: str) -> DataFrame:
    utc(spark)
    return landing.order_detail(spark, sf)


def _docs(spark: SparkSession, sf: str, *columns: str, days: int = 1) -> DataFrame:
    """Stored order documents of the last ``days`` days up to the queried one."""
    utc(spark)
    return landing.order_docs(spark, sf, days_up_to(ORDER_DAY, days), *columns)


# ---- logs ----------------------------------------------------------------------------


def _stream(spark: SparkSession, idle_batches: bool = False) -> SparkSession:
    return stream_session(spark, spark.sparkContext.defaultParallelism, idle_batches)


def _topic_stream(session: SparkSession, sf: str, name: str) -> DataFrame:
    return file_topic(session, landing.path_of(session, sf, name))


@query
def raw_log_source(spark: SparkSession, sf: str) -> DataFrame:
    """The topic source: every landed record arrives once, with its position and key."""
    session = _stream(spark)
    stream = _topic_stream(session, sf, "raw_log")
    out = scratch_dir(session, "raw-log-read")
    rows = stream.select("topic", "partition", "offset", "key", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-checkpoint")
    writer.trigger(**ONCE).start().awaitTermination()
    return spark.read.parquet(out)


@query
def log_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(
        F.col("common.mid").alias("mid"),
        "ts",
        F.col("err").isNotNull().cast("int").alias("has_err"),
        F.col("page").isNotNull().cast("int").alias("has_page"),
        F.col("start").isNotNull().cast("int").alias("has_start"),
        F.coalesce(F.array_size("displays"), F.lit(0)).alias("n_displays"),
        F.coalesce(F.array_size("actions"), F.lit(0)).alias("n_actions"),
    )


@query
def log_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return logs.split_counts(_parsed(spark, sf))


@query
def log_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Page records to JSON and back: NULL fields are left out, the rest returns unchanged."""
    pages = _pages(spark, sf)
    messages = pages.select(F.to_json(F.struct(*pages.columns)).alias("value"))
    fields = F.array_size(F.json_object_keys("value"))
    parsed = logs.parse_json(messages, pages.schema)
    return parsed.select("mid", "page_id", "last_page_id", "during_time", "ts", fields.alias("n_fields"))


@query
def log_topics_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The log split job into topic folders: messages per topic and key."""
    session = _stream(spark)
    out = scratch_dir(session, "log-topics")
    stream = _topic_stream(session, sf, "raw_log")
    jobs.log_split(stream, out + "-checkpoint", path=out, trigger=ONCE).awaitTermination()
    written = spark.read.schema("key STRING, value STRING, topic STRING").parquet(out)
    return written.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("n"))


@query
def page_log(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf)


@query
def page_display_log(spark: SparkSession, sf: str) -> DataFrame:
    return logs.page_display_log(_parsed(spark, sf))


@query
def page_action_log(spark: SparkSession, sf: str) -> DataFrame:
    return logs.page_action_log(_parsed(spark, sf))


@query
def start_log(spark: SparkSession, sf: str) -> DataFrame:
    return logs.start_log(_parsed(spark, sf))


@query
def error_log(spark: SparkSession, sf: str) -> DataFrame:
    def field(path: str):
        return F.get_json_object("value", path)

    return logs.error_log(_parsed(spark, sf)).select(
        field("$.common.mid").alias("mid"),
        field("$.err.error_code").cast("bigint").alias("error_code"),
        field("$.err.msg").alias("msg"),
        field("$.page.page_id").alias("page_id"),
        field("$.ts").cast("bigint").alias("ts"),
    )


@query
def page_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    """What a reader of the page topic gets out of the split messages."""
    return logs.parse_page_log(logs.fan_out(_parsed(spark, sf)).where(F.col("topic") == PAGE_TOPIC))


@query
def page_log_dt_hr(spark: SparkSession, sf: str) -> DataFrame:
    return dau.with_day(_pages(spark, sf)).select("mid", "page_id", "ts", "dt", "hr")


@query
def session_entry_pages(spark: SparkSession, sf: str) -> DataFrame:
    return dau.session_entries(_pages(spark, sf))


# ---- change records ------------------------------------------------------------------


@query
def cdc_op_map(spark: SparkSession, sf: str) -> DataFrame:
    return _changes(spark, sf).select(F.col("table").alias("table_name"), "id", "type", "op", "ts")


@query
def cdc_fact_route(spark: SparkSession, sf: str) -> DataFrame:
    facts = cdc.fact_messages(_changes(spark, sf), samples.table_lists(spark))
    return facts.select("topic", "key", F.get_json_object("value", "$.id").cast("bigint").alias("id"))


@query
def cdc_dim_route(spark: SparkSession, sf: str) -> DataFrame:
    rows = cdc.dim_rows(_changes(spark, sf), samples.table_lists(spark))
    return rows.select("table_name", "id", "op", "ts", F.get_json_object("data", "$.name").alias("name"))


@query
def dim_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    last = cdc.latest_dim(cdc.dim_rows(_changes(spark, sf), samples.table_lists(spark)))
    return last.select("table_name", "id", "op", "ts", F.get_json_object("data", "$.name").alias("name"))


@query
def cdc_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The change routing job, table lists read per batch: the dimension table it leaves behind."""
    session = _stream(spark)
    root = scratch_dir(session, "cdc")
    samples.table_lists(session).write.parquet(f"{root}/lists")
    jobs.cdc_route(
        _topic_stream(session, sf, "cdc"),
        lambda s: s.read.parquet(f"{root}/lists"),
        f"{root}/dims",
        f"{root}/checkpoint",
        path=f"{root}/facts",
        trigger=ONCE,
    ).awaitTermination()
    rows = table.read_current(spark, f"{root}/dims", DIM_ROW, "id", "table_name")
    return rows.select("table_name", "id", "op", "ts", F.get_json_object("data", "$.name").alias("name"))


@query
def cdc_stream_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The change routing job over several batches, with a list edited between two starts: what it left in the dimension
    table and in the fact topics. Items are a dimension from the second start on."""
    session = _stream(spark)
    root = scratch_dir(session, "cdc-batches")
    records = landing.topic(session, sf, "cdc")
    lists = samples.table_lists(session)
    later = (F.col("list_name") == cdc.DIM_LIST) & (F.col("table_name") == "sku_info")

    def run() -> None:
        stream = file_topic(session, f"{root}/changes", max_files=2)
        jobs.cdc_route(
            stream, lambda s: required_lists(s, f"{root}/lists"), f"{root}/dims", f"{root}/checkpoint", path=f"{root}/facts", trigger=ONCE
        ).awaitTermination()

    for odd, listed in ((0, lists.where(~later)), (1, lists)):
        land(records.where(F.col("offset") % 2 == odd), RAW_CDC_TOPIC, f"{root}/changes", pieces=4)
        listed.write.mode("overwrite").parquet(f"{root}/lists")
        run()
    rows = table.read_current(spark, f"{root}/dims", DIM_ROW, "id", "table_name")
    facts = spark.read.schema("key STRING, topic STRING").parquet(f"{root}/facts")
    images = rows.select(F.lit("dimension").alias("kind"), F.col("table_name").alias("name"), "id", "op")
    return images.unionByName(facts.select(F.lit("fact").alias("kind"), F.col("topic").alias("name"), F.col("key").alias("id"), F.lit(None).cast("string").alias("op")))


# ---- dimensions ----------------------------------------------------------------------


@query
def user_age(spark: SparkSession, sf: str) -> DataFrame:
    utc(spark)
    known = samples.user_info(spark, sf)
    age = age_years(F.col("birthday"), AS_OF).alias("age")
    return known.select("id", "birthday", age, F.date_sub(as_date(AS_OF), 1).cast("string").alias("day_before"))


@query
def enrich_user(spark: SparkSession, sf: str) -> DataFrame:
    enriched = dims.enrich_user(_infos(spark, sf), samples.user_info(spark, sf), AS_OF, keep_found=True)
    found = F.col("user_found").cast("int").alias("user_found")
    return enriched.select("id", "user_id", "user_gender", "user_age", found)


@query
def enrich_province(spark: SparkSession, sf: str) -> DataFrame:
    enriched = dims.enrich_province(_infos(spark, sf), samples.base_province(spark, sf))
    return enriched.select(
        "id", "province_id", "province_name", "province_area_code", "province_iso_code", "province_3166_2"
    )


# ---- daily actives -------------------------------------------------------------------


@query
def dau_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return dau.first_seen(_entries(spark, sf)).select("mid", "dt", "hr", "user_id", "page_id", "page_item", "ts")


@query
def dau_wide(spark: SparkSession, sf: str) -> DataFrame:
    first = dau.first_seen(_entries(spark, sf))
    return dau.dau_wide(first, samples.user_info(spark, sf), samples.base_province(spark, sf), AS_OF)


@query
def dau_first_seen_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The daily-active job from the page topic to stored documents."""
    session = _stream(spark)
    root = scratch_dir(session, "dau")
    jobs.dau_documents(
        _topic_stream(session, sf, "page"),
        *landing.lookups(session, sf),
        f"{root}/docs",
        f"{root}/checkpoint",
        AS_OF,
        trigger=ONCE,
    ).awaitTermination()
    return table.read_current(spark, f"{root}/docs", DAU_INFO, "mid", "dt", columns=["user_id", "province_name"])


@query
def pipeline_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Three jobs in a row, each fed by what the one before left: raw logs to page records, changes to dimensions, and
    both to the stored documents of first-seen devices."""
    session = _stream(spark)
    root = scratch_dir(session, "chain")
    samples.table_lists(session).write.parquet(f"{root}/lists")
    topics, dimensions = f"{root}/topics", f"{root}/dims"
    jobs.log_split(_topic_stream(session, sf, "raw_log"), f"{root}/log-checkpoint", path=topics, trigger=ONCE).awaitTermination()
    jobs.cdc_route(
        _topic_stream(session, sf, "cdc"),
        lambda s: required_lists(s, f"{root}/lists"),
        dimensions,
        f"{root}/cdc-checkpoint",
        path=topics,
        trigger=ONCE,
    ).awaitTermination()
    jobs.dau_documents(
        file_topic(session, topic_folder(topics, PAGE_TOPIC)),
        lambda s, ids: users(s, dimensions, ids),
        lambda s, ids: provinces(s, dimensions, ids),
        f"{root}/docs",
        f"{root}/dau-checkpoint",
        AS_OF,
        trigger=ONCE,
    ).awaitTermination()
    return table.read_current(spark, f"{root}/docs", DAU_INFO, "mid", "dt", columns=["user_id", "user_gender", "province_name"])


@query
def record_balance(spark: SparkSession, sf: str) -> DataFrame:
    """What the log split, the change routing and the daily actives read, and where each record went, from the kept account.
    The raw logs come in two starts, the second with some unreadable records."""
    session = _stream(spark)
    root = scratch_dir(session, "balance")
    account = balance.Account(session, f"{root}/account")
    samples.table_lists(session).write.parquet(f"{root}/lists")
    records, changes = landing.topic(session, sf, "raw_log"), landing.topic(session, sf, "cdc")
    broken = F.when(F.col("offset") % 89 == 0, F.lit("{broken")).otherwise(F.col("value")).alias("value")
    middle = F.lit("2024-01-16").cast("timestamp")
    late = records.where(F.col("timestamp") >= middle).select("key", broken, "offset", "timestamp")
    land(changes.select("key", broken, "offset", "timestamp"), RAW_CDC_TOPIC, f"{root}/changes")

    def pages() -> StreamingQuery:
        stream = file_topic(session, f"{root}/raw")
        return jobs.log_split(stream, f"{root}/log-checkpoint", path=f"{root}/topics", trigger=ONCE)

    def routed() -> StreamingQuery:
        stream = file_topic(session, f"{root}/changes", max_files=4)
        lists, out = (lambda s: required_lists(s, f"{root}/lists")), f"{root}/dims"
        return jobs.cdc_route(stream, lists, out, f"{root}/cdc-checkpoint", path=f"{root}/facts", trigger=ONCE, account=account.path)

    def actives() -> StreamingQuery:
        stream = file_topic(session, topic_folder(f"{root}/topics", PAGE_TOPIC))
        return jobs.dau_documents(stream, *landing.lookups(session, sf), f"{root}/docs", f"{root}/dau-checkpoint", AS_OF, trigger=ONCE)

    session.streams.addListener(account)
    try:
        for part in (records.where(F.col("timestamp") < middle), late):
            land(part, RAW_LOG_TOPIC, f"{root}/raw")
            _ended(account, pages())
        for job in (routed, actives):
            _ended(account, job())
    finally:
        session.streams.removeListener(account)
    return balance.balance(spark, account.path)


def _ended(account: balance.Account, query: StreamingQuery) -> None:
    query.awaitTermination()
    if not account.settled(query):
        raise TimeoutError("the account of a job that has ended is not complete")


@query
def dau_by_hour_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly job over the page topic in two parts. With the second come pages of the first's last hour, which still
    count, and pages of days long closed, which do not."""
    session = _stream(spark, idle_batches=True)
    root = scratch_dir(session, "hourly")
    pages = landing.topic(session, sf, "page")
    middle, millis = F.lit("2024-01-16").cast("timestamp"), F.col("offset")
    within = (F.col("timestamp") >= middle - F.expr("INTERVAL 1 HOUR")) & (millis % 2 == 0)
    closed = F.col("timestamp").between("2024-01-05", "2024-01-11") & (millis % 97 == 0)
    early = (F.col("timestamp") < middle) & ~within & ~closed
    for part in (early, ~early):
        land(pages.where(part), PAGE_TOPIC, f"{root}/page")
        stream = file_topic(session, f"{root}/page")
        jobs.hourly_actives(stream, f"{root}/hours", f"{root}/checkpoint", trigger=ONCE).awaitTermination()
    return read_days(spark, f"{root}/hours", HOURLY_ACTIVES, days_up_to(LAST_DAY, 31))


@query
def dau_state_seed(spark: SparkSession, sf: str) -> DataFrame:
    """A start without checkpoint: what the day's afternoon adds to the devices its morning has stored."""
    root = scratch_dir(spark, "dau-seed")
    entries = dau.session_entries(_dated(spark, sf, days=1))
    morning = dau.first_seen(entries.where(F.col("hr") < "12"))
    docs = dau.dau_wide(morning, samples.user_info(spark, sf), samples.base_province(spark, sf), AS_OF)
    table.upsert(docs, f"{root}/docs", "mid", "dt", "morning-0", order=("ts",))
    seen = jobs.restore_devices(spark, f"{root}/docs", TD, f"{root}/seen")(spark)
    return dau.first_seen(dau.unseen(entries, seen)).select("mid", "dt", "hr", "ts")


@query
def dau_total(spark: SparkSession, sf: str) -> DataFrame:
    return reports.dau_total(_hours(spark, sf, TD), TD)


@query
def dau_total_missing_day(spark: SparkSession, sf: str) -> DataFrame:
    return reports.dau_total(_hours(spark, sf, MISSING_DAY), MISSING_DAY)


@query
def dau_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return reports.dau_by_hour(_hours(spark, sf, TD), TD)


@query
def dau_by_hour_filled(spark: SparkSession, sf: str) -> DataFrame:
    return reports.fill_hours(reports.dau_by_hour(_hours(spark, sf, TD), TD))


@query
def dau_realtime(spark: SparkSession, sf: str) -> DataFrame:
    return reports.dau_realtime(_hours(spark, sf, TD, reports.day_before(TD)), TD)


@query
def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Log split stopped half-way and restarted from its checkpoint: every page record once."""
    session = _stream(spark)
    root = scratch_dir(session, "resume")
    records = landing.topic(session, sf, "raw_log")
    middle = F.lit("2024-01-16").cast("timestamp")

    def run() -> None:
        stream = file_topic(session, f"{root}/landed")
        jobs.log_split(stream, f"{root}/checkpoint", path=f"{root}/topics", trigger=ONCE).awaitTermination()

    land(records.where(F.col("timestamp") < middle), RAW_LOG_TOPIC, f"{root}/landed")
    run()
    land(records.where(F.col("timestamp") >= middle), RAW_LOG_TOPIC, f"{root}/landed")
    run()
    written = spark.read.schema("key STRING, value STRING, topic STRING").parquet(f"{root}/topics")
    return logs.parse_page_log(written.where(F.col("topic") == PAGE_TOPIC)).select("mid", "page_id", "page_item", "ts")


# ---- orders --------------------------------------------------------------------------


@query
def order_parse(spark: SparkSession, sf: str) -> DataFrame:
    utc(spark)
    return orders.parse_order_info(landing.topic(spark, sf, "order_info_topic"))


@query
def order_detail_parse(spark: SparkSession, sf: str) -> DataFrame:
    utc(spark)
    return orders.parse_order_detail(landing.topic(spark, sf, "order_detail_topic"))


@query
def order_date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return orders.with_create_parts(_infos(spark, sf)).select("id", "create_time", "create_date", "create_hour")


@query
def order_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    return orders.order_full_outer(_infos(spark, sf), _details(spark, sf))


@query
def order_wide(spark: SparkSession, sf: str) -> DataFrame:
    utc(spark)
    return landing.order_wide(spark, sf)


@query
def order_wide_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The order job over two topics, stopped in the middle of the period and resumed: the stored documents."""
    session = _stream(spark)
    root = scratch_dir(session, "orders")
    infos = landing.topic(session, sf, "order_info_topic")
    details = landing.topic(session, sf, "order_detail_topic")
    middle = F.lit("2024-01-06").cast("timestamp")

    def run() -> None:
        jobs.order_documents(
            file_topic(session, f"{root}/info"),
            file_topic(session, f"{root}/detail"),
            *landing.lookups(session, sf),
            f"{root}/docs",
            f"{root}/checkpoint",
            AS_OF,
            trigger=ONCE,
        ).awaitTermination()

    for part in (F.col("timestamp") < middle, F.col("timestamp") >= middle):
        land(infos.where(part), ORDER_INFO_TOPIC, f"{root}/info")
        land(details.where(part), ORDER_DETAIL_TOPIC, f"{root}/detail")
        run()
    stored = table.read_current(spark, f"{root}/docs", ORDER_WIDE_STORED, "detail_id", "dt")
    return stored.drop("dt")


@query
def order_late_expired(spark: SparkSession, sf: str) -> DataFrame:
    return orders.late_pairs(_infos(spark, sf), _details(spark, sf))


@query
def sink_upsert_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """A batch, its replay, and a later batch that rewrites half of the documents: the current view."""
    utc(spark)
    path = scratch_dir(spark, "order-docs")
    stored = landing.path_of(spark, sf, "order_docs")
    docs = table.read_current(spark, stored, ORDER_WIDE_STORED, "detail_id", "dt", plain=True)
    later = docs.where(F.col("order_id") % 2 == 0).withColumn("order_status", F.lit("Z"))
    for rows, batch in ((docs, "orders-0"), (docs, "orders-0"), (later, "orders-1")):
        table.upsert(rows, path, "detail_id", "dt", batch, order=("create_time",), unique=True)
    current = table.read_current(
        spark, path, ORDER_WIDE_STORED, "detail_id", "dt", columns=["order_id", "order_status", "split_total_amount"]
    )
    return current.withColumn("doc_id", F.col("detail_id").cast("string")).drop("detail_id")


# ---- item reports --------------------------------------------------------------------


@query
def item_search(spark: SparkSession, sf: str) -> DataFrame:
    found = reports.item_search(_docs(spark, sf, "order_id", "sku_name", "create_time"), ITEM, ORDER_DAY)
    return found.select("detail_id", "order_id", "sku_name", "create_time")


@query
def item_search_ranked(spark: SparkSession, sf: str) -> DataFrame:
    ranked = reports.item_ranked(_docs(spark, sf, "sku_name"), ITEM, ORDER_DAY)
    return ranked.select("detail_id", "sku_name", F.round("score", 6).alias("score"))


@query
def item_search_postings(spark: SparkSession, sf: str) -> DataFrame:
    """The ranked search from the terms' postings: no name is read or split."""
    utc(spark)
    path, terms = landing.path_of(spark, sf, "postings"), query_terms(spark, ITEM)
    found = reports.postings_scored(postings.of_terms(spark, path, ORDER_DAY, terms), postings.stats(spark, path, ORDER_DAY), terms)
    return found.select("detail_id", F.round("score", 6).alias("score"))


@query
def item_highlight(spark: SparkSession, sf: str) -> DataFrame:
    return reports.item_highlight(_docs(spark, sf, "sku_name"), ITEM_ONE_TERM, ORDER_DAY).select("detail_id", "sku_name")


@query
def item_sum_by_age(spark: SparkSession, sf: str) -> DataFrame:
    return reports.item_buckets(_docs(spark, sf, "sku_name", "user_age", "split_total_amount"), ITEM_ONE_TERM, ORDER_DAY, "user_age")


@query
def item_sum_by_gender(spark: SparkSession, sf: str) -> DataFrame:
    return reports.item_buckets(_docs(spark, sf, "sku_name", "user_gender", "split_total_amount"), ITEM_ONE_TERM, ORDER_DAY, "user_gender")


@query
def item_top_ages(spark: SparkSession, sf: str) -> DataFrame:
    buckets = reports.item_buckets(_docs(spark, sf, "sku_name", "user_age", "split_total_amount"), ITEM_ONE_TERM, ORDER_DAY, "user_age")
    return reports.top_buckets(buckets, "user_age", 10)


@query
def stats_by_item_age(spark: SparkSession, sf: str) -> DataFrame:
    return reports.stats_by_item(_docs(spark, sf, "sku_name", "user_age", "split_total_amount"), ITEM, ORDER_DAY, "age")


@query
def stats_by_item_gender(spark: SparkSession, sf: str) -> DataFrame:
    return reports.stats_by_item(_docs(spark, sf, "sku_name", "user_gender", "split_total_amount"), ITEM, ORDER_DAY, "gender")


@query
def detail_total(spark: SparkSession, sf: str) -> DataFrame:
    return reports.detail_total(_docs(spark, sf, "sku_name"), ITEM, ORDER_DAY)


@query
def detail_by_item(spark: SparkSession, sf: str) -> DataFrame:
    return reports.detail_by_item(_docs(spark, sf, *reports.DETAIL_COLUMNS), ITEM, ORDER_DAY)


@query
def detail_page_2(spark: SparkSession, sf: str) -> DataFrame:
    return reports.detail_by_item(_docs(spark, sf, *reports.DETAIL_COLUMNS), ITEM_ONE_TERM, ORDER_DAY, page_no=2)


@query
def detail_after(spark: SparkSession, sf: str) -> DataFrame:
    """The page after the first one's last row."""
    docs = _docs(spark, sf, *reports.DETAIL_COLUMNS)
    last = reports.detail_after(docs, ITEM_ONE_TERM, ORDER_DAY).select("score", "detail_id").tail(1)
    return reports.detail_after(docs, ITEM_ONE_TERM, ORDER_DAY, tuple(last[0]) if last else None).drop("score", "detail_id")


# ---- dashboard -----------------------------------------------------------------------


def _dated(spark: SparkSession, sf: str, day: str = TD, days: int = dashboard.DEFAULT_DAYS) -> DataFrame:
    """The stored page records of the last ``days`` days up to ``day``."""
    utc(spark)
    return landing.page_days(spark, sf, days_up_to(day, days))


def _bitmaps(spark: SparkSession, sf: str, day: str = TD, days: int = dashboard.DEFAULT_DAYS) -> DataFrame:
    return landing.device_bitmaps(spark, sf, days_up_to(day, days))


def _skus(spark: SparkSession, sf: str) -> DataFrame:
    parts = samples.table(spark, sf, "part")
    return parts.select(F.col("p_partkey").alias("sku_id"), F.col("p_brand").alias("tm"), F.col("p_type").alias("category"))


@query
def pv_count(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.pv_count(_dated(spark, sf), TD)


@query
def uv_count(spark: SparkSession, sf: str) -> DataFrame:
    return uv.uv_by_day(_bitmaps(spark, sf))


@query
def uv_period(spark: SparkSession, sf: str) -> DataFrame:
    """Devices of thirty days, from the days' bitmaps alone."""
    return uv.uv_period(_bitmaps(spark, sf, LAST_DAY, 30))


@query
def visit_total(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.visit_total_of(dashboard.pv_count(_dated(spark, sf), TD), _bitmaps(spark, sf))


@query
def visit_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """The week's visits."""
    return sessions.visits(_dated(spark, sf)).drop("begin")


@query
def new_visit_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = dashboard.new_visit_stats(_dated(spark, sf), TD)
    return stats.select("metric", F.round("old", 6).alias("old"), F.round("new", 6).alias("new"))


@query
def channel_pv(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.channel(_dated(spark, sf), TD, "pv")


@query
def channel_bounce(spark: SparkSession, sf: str) -> DataFrame:
    rates = dashboard.channel(_dated(spark, sf), TD, "br")
    return rates.select("name", F.round("value", 6).alias("value"))


@query
def page_path(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.page_path(_dated(spark, sf), TD)


@query
def user_action_convert(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.user_action_convert(_dated(spark, sf), TD)


@query
def user_paid(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.user_paid(samples.user_info(spark, sf), _docs(spark, sf, "user_id", days=3), ORDER_DAY, 3)


@query
def user_total(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf, "order_id", "user_id", "province_name", "total_amount", days=7)
    total = dashboard.user_total(samples.user_info(spark, sf), _dated(spark, sf, ORDER_DAY), docs, ORDER_DAY)
    return total.withColumn("pct", F.round("pct", 4))


@query
def order_total(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.order_total(_docs(spark, sf, "order_id", "user_id", "province_name", "total_amount", days=3), ORDER_DAY, 3)


@query
def area_orders(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.area(_docs(spark, sf, "order_id", "user_id", "province_name", "total_amount", days=3), ORDER_DAY, 3)


@query
def top_spu(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_sales(_docs(spark, sf, "sku_name", "split_total_amount", days=7), ORDER_DAY, "sku_name")


@query
def top_tm(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_sales(_docs(spark, sf, "sku_id", "split_total_amount", days=7), ORDER_DAY, "tm", skus=_skus(spark, sf))


@query
def top_category(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf, "sku_id", "split_total_amount", days=7)
    return dashboard.top_sales(docs, ORDER_DAY, "category", num=3, skus=_skus(spark, sf))
