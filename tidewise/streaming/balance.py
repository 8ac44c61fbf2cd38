"""A kept account of the records of each batch: how many a job read, and where they went.

``Account`` listens to the queries of a session and writes what a batch's observed counts and its stateful steps say to
a table, one folder for each query and batch, so that a replayed batch replaces its own numbers and progress that the
session has forgotten stays known. ``balance`` sums it up by source: ``read`` is the sum of a source's other rows, the last of
which (``other``, ``routed``, ``repeated``, ``kept``) is not counted but what the counted ones leave.
"""

from __future__ import annotations

import json
import threading
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COUNTS = "metric STRING, field STRING, n BIGINT"
LATE = "late"


def write_counts(session: SparkSession, path: str, query_id: str, batch_id: int, counts: list[tuple[str, str, int]], part: str) -> None:
    rows = session.createDataFrame(counts, COUNTS).coalesce(1)
    rows.write.mode("overwrite").parquet(f"{path}/_query={query_id}/_batch={batch_id}/_part={part}")


class Account(StreamingQueryListener):
    """Writes a batch's counts as its progress is reported. ``settled`` waits for a query that has ended."""

    def __init__(self, session: SparkSession, path: str) -> None:
        self.session, self.path = session, path
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        counts = counts_of(progress)
        if counts:
            write_counts(self.session, self.path, progress["id"], progress["batchId"], counts, "progress")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def settled(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Whether all of an ended query's batches are written: its end is reported after them."""
        return self._end_of(str(query.runId)).wait(seconds)


def counts_of(progress: dict) -> list[tuple[str, str, int]]:
    """The observed counts of a batch, and how many rows its stateful steps dropped as too late."""
    observed = progress.get("observedMetrics") or {}
    counts = [(metric, field, int(n)) for metric, fields in observed.items() for field, n in fields.items() if n is not None]
    late = sum(int(step.get("numRowsDroppedByWatermark", 0)) for step in progress.get("stateOperators", []))
    return [*counts, (LATE, next(iter(observed)), late)] if counts else []


def balance(spark: SparkSession, path: str) -> DataFrame:
    """(source, fate, n) over all batches of all queries kept in ``path``."""
    kept = spark.read.schema(COUNTS).option("recursiveFileLookup", "true").parquet(path)

    def total(metric: str, *fields: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("metric") == metric) & F.col("field").isin(*fields), F.col("n"))), F.lit(0))

    fates: list[tuple[str, str, Column]] = []

    def source(name: str, read: Column, parts: dict[str, Column], rest: str) -> None:
        """``rest`` is what became of those that no part names."""
        fates.append((name, "read", read))
        fates.extend((name, fate, n) for fate, n in parts.items())
        fates.append((name, rest, reduce(lambda left, n: left - n, parts.values(), read)))

    routes = {fate: total("log_routes", fate) for fate in ("corrupt", "error", "page", "start")}
    source("raw log", total("log_quality", "records"), routes, "other")
    changes = {fate: total("changes", fate) for fate in ("corrupt", "no_change", "unlisted")}
    source("change", total("changes", "records"), changes, "routed")
    bad = {fate: total("page_quality", fate) for fate in ("corrupt", "no_key")}
    whole = total("page_quality", "records") - bad["corrupt"] - bad["no_key"]
    ended = {"later_page": whole - total("entries", "records"), "first": total("first_seen", "records"), "late": total(LATE, "page_quality", "entries", "first_seen")}
    source("page", total("page_quality", "records"), {**bad, **ended}, "repeated")
    for name, metric in (("order header", "info_quality"), ("order line", "detail_quality")):
        source(name, total(metric, "records"), {fate: total(metric, fate) for fate in ("corrupt", "no_key")}, "kept")
    rows = [F.struct(F.lit(name).alias("source"), F.lit(fate).alias("fate"), n.cast("bigint").alias("n")) for name, fate, n in fates]
    return kept.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
