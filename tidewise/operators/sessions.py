"""Visits: the pages a device sees from an entry page (one reached from nowhere) up to the next.

A page's visit is the number of its device's entries up to it, a running sum. So that a device with a large share of all
pages does not land in one task, the sum has two levels: entries are counted per device and slice of time (partial sums
meet in the shuffle), the slices before are added up over those counts, and only the pages of one slice are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a slice of time.
SLICE_MS = 600_000


def _place() -> list[Column]:
    """Order of a device's pages; an entry comes before other pages of its millisecond."""
    return [F.col("ts"), F.col("last_page_id").isNotNull(), F.col("page_id"), F.col("page_item"), F.col("last_page_id")]


def with_visit(pages: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """Add ``visit``: 0 before the device's first entry among these rows, then 1, 2, ... Pages without device or time go."""
    entry = F.col("last_page_id").isNull().cast("long")
    rows = pages.where("mid IS NOT NULL AND ts IS NOT NULL").withColumn("_slice", F.floor(F.col("ts") / F.lit(slice_ms)))
    counts = rows.groupBy("mid", "_slice").agg(F.sum(entry).alias("_entries"))
    earlier = Window.partitionBy("mid").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("mid", "_slice", F.coalesce(F.sum("_entries").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("mid", "_slice").orderBy(*_place()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn("_inside", F.sum(entry).over(inside)).join(before, ["mid", "_slice"])
    return numbered.select(*pages.columns, (F.col("_before") + F.col("_inside")).alias("visit"))


def visits(pages: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """One row per visit: where and when it began, its channel, whether the device was new, its pages and their time.

    Pages before a device's first entry make a visit of their own: it began before these rows do.
    """
    first = F.struct(*_place())
    return (
        with_visit(pages, slice_ms)
        .groupBy("mid", "visit")
        .agg(
            F.min("ts").alias("begin"),
            F.min("dt").alias("dt"),
            F.min_by("page_id", first).alias("entry_page"),
            F.min_by("channel", first).alias("channel"),
            F.max(F.when(F.col("is_new") == "1", 1).otherwise(0)).alias("is_new"),
            F.count(F.lit(1)).alias("pages"),
            F.sum("during_time").alias("millis"),
        )
    )
