"""Stateful stream operators: first-seen, de-duplication and the day-apart join.

A stream cannot combine rows before a stateful shuffle, so a key with a large
share of them would keep one task busy. ``thin`` therefore drops repeats of a key
inside each Arrow batch first. It needs no state and decides nothing: the
stateful round after it does.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.orders import JOIN_SECONDS

SLICES = 4
_EXCLUDED, _NO_SORT = "spark.sql.optimizer.excludedRules", "org.apache.spark.sql.catalyst.optimizer.EliminateSorts"


@contextlib.contextmanager
def sorted_batches(session: SparkSession) -> Iterator[None]:
    """Let a stream that is started in here sort each batch's rows within their tasks; the session is then as before.

    Spark turns down any sort of a stream, as it cannot sort one as a whole, and leaves out sorts below a join. No result
    depends on this order, only the time that state takes.
    """
    rules = session.conf.get(_EXCLUDED, None)
    wanted = {"spark.sql.streaming.unsupportedOperationCheck": "false", _EXCLUDED: f"{rules},{_NO_SORT}" if rules else _NO_SORT}
    before = {name: session.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            session.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            session.conf.unset(name) if value is None else session.conf.set(name, value)


def stored_order(key: Column) -> Column:
    """A number that sorts 64-bit keys as they lie in a state store: by their bytes, the lowest first."""
    turned = [F.shiftleft(F.shiftright(key, 8 * i).bitwiseAND(F.lit(255)), 56 - 8 * i) for i in range(8)]
    return reduce(Column.bitwiseOR, turned).bitwiseXOR(F.lit(-(1 << 63)))


def _as_stored(rows: DataFrame, *keys: Column) -> DataFrame:
    """The shuffle that a stateful step asks for, and each task's rows in the order of its store, by the first key.

    What is then asked of the store lies in the block that was read for the row before; in any other order each question
    unpacks a block of its own, once the state is larger than the store's cache.
    """
    return rows.repartition(*keys).sortWithinPartitions(stored_order(keys[0]), *keys[1:])


def thin(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the first row of each key within every Arrow batch of a task."""
    keys = list(keys)

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch.select(keys)])
            numbered = table.append_column("_row", pa.array(range(batch.num_rows), pa.int64()))
            firsts = numbered.group_by(keys).aggregate([("_row", "min")])["_row_min"]
            yield batch.take(firsts.combine_chunks())

    return rows.mapInArrow(first_rows, rows.schema)


def first_seen_stream(entries: DataFrame, delay: str = "48 hours") -> DataFrame:
    """The first arriving entry of each (mid, day); ``entries`` carry their ``arrival``.

    A device is remembered for ``delay`` after it first arrived, whatever day its
    record names, so a record of a day long past counts like any other. What
    comes again later than that has to be looked up among the stored documents.
    """
    dated = thin(entries.withColumn("day", F.date_trunc("day", F.timestamp_millis("ts"))), ["mid", "day"])
    return dated.withWatermark("arrival", delay).dropDuplicatesWithinWatermark(["mid", "day"]).drop("day")


def hourly_actives_stream(entries: DataFrame, delay: str = "2 hours") -> DataFrame:
    """(dt, hr, n): devices by the hour of their first entry of a day, appended for good once the day is over by ``delay``.

    Two windowed aggregates in a row: the earliest entry of each device in its day, however late in the day it arrives,
    then the devices of each hour. Both combine before their shuffle, so a device with a third of all entries sends one
    row a task. State holds a row for each device of the open days. Entries of a closed day are dropped and counted.
    """
    timed = entries.withColumn("time", F.timestamp_millis("ts")).withWatermark("time", delay)
    first = timed.groupBy(F.window("time", "1 day").alias("day"), "mid").agg(F.min("time").alias("first"))
    hours = first.groupBy(F.window("day", "1 day").alias("day"), F.date_format("first", "HH").alias("hr")).agg(F.count(F.lit(1)).alias("n"))
    return hours.select(F.date_format("day.start", "yyyy-MM-dd").alias("dt"), "hr", "n")


def distinct_stream(rows: DataFrame, time: str, delay: str, ignore: Sequence[str] = (), in_order: bool = False) -> DataFrame:
    """Rows that differ in content from all rows of the last ``delay``: a re-sent row is dropped, a changed one passes."""
    content = F.xxhash64(*[c for c in rows.columns if c not in (time, *ignore)])
    marked = rows.withColumn("_content", content).withWatermark(time, delay)
    if in_order:
        marked = _as_stored(marked, F.col("id"), F.col("_content"))
    return marked.dropDuplicatesWithinWatermark(["id", "_content"]).drop("_content")


def join_orders_stream(
    infos: DataFrame, details: DataFrame, delay: str = "24 hours", slices: int = SLICES, keep: str = "72 hours", in_order: bool = False
) -> DataFrame:
    """Pairs (``i``, ``d``) of equal order created at most a day apart, whichever side comes first.

    ``infos`` and ``details`` carry their own times ``info_ts`` and ``detail_ts``,
    which decide what belongs together, and their ``arrival``, which alone decides
    how long they are remembered: ``keep`` after they came. An order that arrives
    whole but late is joined. Headers re-sent unchanged are dropped before the
    join, so copies never multiply; a changed header meets the lines again, and
    the sink keeps the newest. An order's lines are spread over ``slices`` state
    partitions, and its header, one row, is copied to each. With ``in_order`` state is asked
    in the order in which it lies: such a stream is started under ``sorted_batches``.
    """
    one_info = distinct_stream(infos, "arrival", delay, ["info_ts"], in_order)
    one_detail = details.withWatermark("arrival", delay)
    left = one_info.select(
        F.struct(*[c for c in infos.columns if c not in ("info_ts", "arrival")]).alias("i"),
        "info_ts",
        F.col("arrival").alias("info_arrival"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("i_slice"),
    )
    right = one_detail.select(
        F.struct(*[c for c in details.columns if c not in ("detail_ts", "arrival")]).alias("d"),
        "detail_ts",
        F.col("arrival").alias("detail_arrival"),
        F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("d_slice"),
    )
    reach, stay = F.expr(f"INTERVAL {JOIN_SECONDS} SECONDS"), F.expr(f"INTERVAL {keep}")
    near = (F.col("detail_ts") >= F.col("info_ts") - reach) & (F.col("detail_ts") <= F.col("info_ts") + reach)
    held = (F.col("detail_arrival") >= F.col("info_arrival") - stay) & (F.col("detail_arrival") <= F.col("info_arrival") + stay)
    same = (F.col("i.id") == F.col("d.order_id")) & (F.col("i_slice") == F.col("d_slice"))
    if in_order:
        left, right = _as_stored(left, F.col("i.id"), F.col("i_slice")), _as_stored(right, F.col("d.order_id"), F.col("d_slice"))
    return left.join(right, same & near & held, "inner").select("i", "d")
