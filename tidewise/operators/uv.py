"""Distinct devices of any period from bitmaps kept per day.

Every device has a number of its own, given once and densely, so a day's devices are a few bitmaps of 32 768 bits, one for
each range of numbers that occurs. Those of several days are or-ed and counted: exact, and without looking at a page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows in a partition that ``monotonically_increasing_id`` leaves room for (a fixed value of that function).
PARTITION_ROWS = 1 << 33

ALL, NEW = "all", "new"


def unnumbered(pages: DataFrame, devices: DataFrame) -> DataFrame:
    """(mid, place) of the devices that have no number yet; write it before ``numbered`` reads it, as places depend on the run."""
    fresh = pages.where("mid IS NOT NULL").select("mid").distinct().join(devices.select("mid"), "mid", "left_anti")
    return fresh.withColumn("place", F.monotonically_increasing_id())


def numbered(fresh: DataFrame, last: int) -> DataFrame:
    """Numbers after ``last``, without gaps: what the tasks before hold is added up over one row for each task."""
    task = F.shiftright("place", PARTITION_ROWS.bit_length() - 1)
    sizes = fresh.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    number = F.col("start") + F.pmod("place", F.lit(PARTITION_ROWS)) + F.lit(last + 1)
    return fresh.withColumn("task", task).join(starts, "task").select("mid", number.alias("number"))


def day_bitmaps(pages: DataFrame, devices: DataFrame) -> DataFrame:
    """(dt, kind, bucket, bitmap): the devices of each day, and of them those that called themselves new."""
    seen = pages.where("mid IS NOT NULL").groupBy("dt", "mid").agg(F.max(F.col("is_new") == "1").alias("new"))
    kinds = F.when(F.col("new"), F.array(F.lit(ALL), F.lit(NEW))).otherwise(F.array(F.lit(ALL)))
    bits = seen.join(devices, "mid").select("dt", F.explode(kinds).alias("kind"), "number")
    where = F.bitmap_bucket_number("number").alias("bucket")
    return bits.groupBy("dt", "kind", where).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def uv_by_day(bitmaps: DataFrame) -> DataFrame:
    """(dt, uv); batches of a day may have a bitmap each for one range."""
    merged = bitmaps.where(F.col("kind") == ALL).groupBy("dt", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("dt").agg(F.sum(F.bitmap_count("bitmap")).alias("uv"))


def uv_period(bitmaps: DataFrame) -> DataFrame:
    """One row (uv_count, new_count): devices of the whole period, each once, and those new on any of its days."""
    merged = bitmaps.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def count(kind: str):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bitmap"))), F.lit(0))

    return merged.agg(count(ALL).alias("uv_count"), count(NEW).alias("new_count"))
