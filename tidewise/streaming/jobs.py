"""The four jobs: log split, change routing, daily actives, order documents.

Progress lives in each query's checkpoint and is committed after the sink, and
the document sinks replace a replayed batch, so a restart neither loses nor
doubles a row. Dimensions and table lists are read inside ``foreachBatch``:
a change to them counts from the next batch. What could not be read or found is
counted along the way: ``log_quality``, ``page_quality``, ``info_quality`` and
``detail_quality`` in the progress of the jobs that read these topics (see
``dropped`` for what came too late, and ``balance`` for a kept account), a log line per batch of the two document
jobs, and unreadable change records go to the corrupt topic.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc, dau, dims, logs, orders
from ..schemas import DAU_INFO, DIM_ROW, ORDER_DETAIL, ORDER_INFO, ORDER_WIDE_STORED, PAGE_DAY, PAGE_LOG, json_form
from ..sinks import topics as topic_sink
from ..sinks.days import write_days
from ..sinks.upsert import parts_of, stored_keys, upsert
from ..sources.tables import DIM_BUCKETS
from . import state
from .balance import write_counts

Loader = Callable[[SparkSession], DataFrame]
# A dimension for one batch: given the ids (column ``id``) its facts refer to, at least those rows.
Lookup = Callable[[SparkSession, DataFrame], DataFrame]
FIVE_SECONDS = {"processingTime": "5 seconds"}
_log = logging.getLogger(__name__)


def _batch_name(rows: DataFrame, batch_id: int) -> str:
    """Stable over replays of a batch, different for a query started on a new checkpoint."""
    query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def _start(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or FIVE_SECONDS)).start()


def log_split(
    raw: DataFrame,
    checkpoint: str,
    path: str | None = None,
    servers: str | None = None,
    trigger: dict | None = None,
    pages: str | None = None,
) -> StreamingQuery:
    """Raw logs to the page, display, action, start, error and corrupt topics, in one query over one read.

    ``pages`` names a table of typed page records by day, written in the same batch.
    """
    parsed = logs.parse_logs(raw).observe("log_quality", *logs.quality_counts()).observe("log_routes", *logs.route_counts())
    if servers and not pages:
        return topic_sink.stream_to_kafka(logs.fan_out(parsed), servers, checkpoint, **(trigger or FIVE_SECONDS))

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Two sinks read the batch when pages are filed too: it is parsed once.
        records = batch.persist() if pages else batch
        try:
            name = _batch_name(batch, batch_id)
            if servers:
                topic_sink.batch_to_kafka(logs.fan_out(records), servers)
            else:
                topic_sink.batch_to_files(logs.fan_out(records), path, name)
            if pages:
                write_days(dau.with_day(logs.page_log(records)).select(*PAGE_DAY.names), pages, name)
        finally:
            if pages:
                records.unpersist()

    return _start(parsed, handle, checkpoint, trigger)


def cdc_route(
    raw: DataFrame,
    lists: Loader,
    dim_path: str,
    checkpoint: str,
    path: str | None = None,
    servers: str | None = None,
    trigger: dict | None = None,
    account: str | None = None,
) -> StreamingQuery:
    """Change records to fact topics and to the dimension table.

    ``account`` names the table of ``balance.Account``: what a batch's lists leave out is known in the batch only.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Held while four outputs are made of it: only what they need of a record.
        parsed = cdc.parse_cdc(batch).select("offset", "table", "type", "ts", "data", "_corrupt").persist()
        try:
            changed = cdc.changes(parsed)
            current = lists(batch.sparkSession)
            name = _batch_name(batch, batch_id)
            messages = cdc.fact_messages(changed, current).unionByName(cdc.corrupt_messages(parsed))
            if servers:
                topic_sink.batch_to_kafka(messages, servers)
            else:
                topic_sink.batch_to_files(messages, path, name)
            images = cdc.dim_rows(changed, current)
            stored = [f.name for f in DIM_ROW]
            upsert(images, dim_path, "id", "table_name", name, seq=batch_id, version=("ts", "offset"), keep=stored, buckets=DIM_BUCKETS)
            if account:
                counts = cdc.route_counts(parsed, current).first().asDict()
                kept = [("changes", fate, n) for fate, n in counts.items()]
                write_counts(batch.sparkSession, account, name.removesuffix(f"-{batch_id}"), batch_id, kept, "routes")
        finally:
            parsed.unpersist()

    return _start(raw, handle, checkpoint, trigger)


def dau_documents(
    pages: DataFrame,
    users: Lookup,
    provinces: Lookup,
    path: str,
    checkpoint: str,
    as_of=None,
    delay: str = "48 hours",
    seen: Loader | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Page topic to one document per device and day.

    ``seen`` gives the (mid, dt) already stored, for a start without the former
    checkpoint (see ``restore_devices``).
    """
    parsed = _parsed_with_arrival(pages, PAGE_LOG, "page_quality", ["mid", "ts"])
    entries = dau.with_day(dau.session_entries(parsed)).observe("entries", F.count(F.lit(1)).alias("records"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        known = batch.persist()
        fresh = _first_of_their_day(known, path)
        fresh = (dau.unseen(fresh, seen(batch.sparkSession)) if seen else fresh).persist()
        try:
            found = Observation()
            enriched = dau.dau_enriched(fresh, *_dims(fresh, users, provinces), as_of, keep_found=True)
            docs = dau.dau_document(enriched.observe(found, *dims.miss_counts()))
            upsert(docs, path, "mid", "dt", _batch_name(batch, batch_id), order=("ts",), seq=batch_id)
            _log.info("daily actives, batch %s: %s", batch_id, found.get)
        finally:
            fresh.unpersist()
            known.unpersist()

    first = state.first_seen_stream(entries, delay).observe("first_seen", F.count(F.lit(1)).alias("records"))
    return _start(first, handle, checkpoint, trigger)


def hourly_actives(
    pages: DataFrame, path: str, checkpoint: str, delay: str = "2 hours", trigger: dict | None = None
) -> StreamingQuery:
    """Page topic to the actives of each hour, by day: (hr, n), written once when a day is over by ``delay``.

    Needs a session in which a batch without input may close a day: ``stream_session(..., idle_batches=True)``.
    """
    parsed = _parsed_with_arrival(pages, PAGE_LOG, "hour_quality", ["mid", "ts"])
    hours = state.hourly_actives_stream(dau.session_entries(parsed).select("mid", "ts"), delay)

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_days(batch.coalesce(1), path, _batch_name(batch, batch_id))

    return _start(hours, handle, checkpoint, trigger)


def _first_of_their_day(batch: DataFrame, path: str) -> DataFrame:
    """Without the devices that are stored already, as far as the state may have forgotten them.

    Only records of days before the day before their arrival can be such; the
    keys of just those days are read, as far as the table has them: a broken
    clock may name any day.
    """
    late = F.coalesce(F.col("dt") < F.date_sub(F.col("arrival").cast("date"), 1).cast("string"), F.lit(False))
    there = parts_of(batch.sparkSession, path, "dt")
    days = [r["dt"] for r in batch.where(late & F.col("dt").isin(there)).select("dt").distinct().collect()] if there else []
    if not days:
        return batch
    stored = stored_keys(batch.sparkSession, path, DAU_INFO, "mid", "dt", days)
    return dau.unseen(batch, stored)


def _dims(facts: DataFrame, users: Lookup, provinces: Lookup) -> tuple[DataFrame, DataFrame]:
    """The dimension rows a batch refers to. The batch is cached, as its ids are read apart from its rows."""

    def ids(column: str) -> DataFrame:
        return facts.select(F.col(column).alias("id")).distinct()

    session = facts.sparkSession
    return users(session, ids("user_id")), provinces(session, ids("province_id"))


def restore_devices(spark: SparkSession, path: str, day: str, snapshot: str) -> Loader:
    """Set aside the devices stored for one day in ``snapshot``, standing in for the state a lost checkpoint held."""
    keys = stored_keys(spark, path, DAU_INFO, "mid", "dt").where(F.col("dt") == day)
    keys.write.mode("overwrite").parquet(snapshot)
    return lambda session: session.read.schema("mid STRING, dt STRING").parquet(snapshot)


def _event_time(text: Column, arrival: Column) -> Column:
    """The record's own time, or its arrival where it has none."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), arrival)


def _parsed_with_arrival(messages: DataFrame, schema, quality: str, needed: list[str]) -> DataFrame:
    """Typed records and their ``arrival``. Unreadable ones, and those without the ``needed`` fields, are counted and left out."""
    parsed = logs.parse_json(messages.select("value", "timestamp"), json_form(schema))
    fields = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    read = parsed.select(*fields, F.col("timestamp").alias("arrival"), F.col("_corrupt").isNotNull().alias("_bad"))
    whole = F.lit(True)
    for name in needed:
        whole = whole & F.col(name).isNotNull()
    counted = read.observe(
        quality,
        F.count(F.lit(1)).alias("records"),
        F.count_if("_bad").alias("corrupt"),
        F.count_if(~F.col("_bad") & ~whole).alias("no_key"),
    )
    return counted.where(~F.col("_bad") & whole).drop("_bad")


def _timed(messages: DataFrame, schema, name: str, needed: list[str]) -> DataFrame:
    parsed = _parsed_with_arrival(messages, schema, name.replace("_ts", "_quality"), needed)
    return parsed.withColumn(name, _event_time(F.col("create_time"), F.col("arrival")))


def dropped(query: StreamingQuery) -> int:
    """Rows that a job's stateful steps dropped because they came later than its delay, as far as progress reaches back."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def order_documents(
    info_topic: DataFrame,
    detail_topic: DataFrame,
    users: Lookup,
    provinces: Lookup,
    path: str,
    checkpoint: str,
    as_of=None,
    delay: str = "24 hours",
    slices: int = state.SLICES,
    keep: str = "72 hours",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Order header and order line topics to one document per line, filed under the order's date."""
    pairs = state.join_orders_stream(
        _timed(info_topic, ORDER_INFO, "info_ts", ["id"]),
        _timed(detail_topic, ORDER_DETAIL, "detail_ts", ["id", "order_id"]),
        delay,
        slices,
        keep,
        in_order=True,
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        wide = orders.wide_of_stream_pairs(batch).persist()
        try:
            found = Observation()
            enriched = orders.enrich_orders(wide, *_dims(wide, users, provinces), as_of, keep_found=True)
            docs = enriched.observe(found, *dims.miss_counts())
            stored = docs.withColumn("dt", F.col("create_date")).select(*ORDER_WIDE_STORED.names)
            name = _batch_name(batch, batch_id)
            upsert(stored, path, "detail_id", "dt", name, seq=batch_id, version=orders.HEADER_VERSION)
            _log.info("orders, batch %s: %s", batch_id, found.get)
        finally:
            wide.unpersist()

    with state.sorted_batches(pairs.sparkSession):
        return _start(pairs, handle, checkpoint, trigger)
