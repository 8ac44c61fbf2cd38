"""Daily active devices: session entries, first seen per day, enriched document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import overlay, pick_one
from ..functions.scalars import day_text, hour_text
from ..schemas import DAU_INFO, PAGE_LOG
from .dims import enrich_province, enrich_user

DAY_KEY = ["mid", "dt"]


def with_day(pages: DataFrame) -> DataFrame:
    """Add ``dt`` and ``hr`` of each row's own time."""
    return pages.withColumn("dt", day_text(F.col("ts"))).withColumn("hr", hour_text(F.col("ts")))


def session_entries(pages: DataFrame) -> DataFrame:
    """Pages reached from nowhere. An empty ``last_page_id`` is not an absent one."""
    return pages.where(F.col("last_page_id").isNull())


def first_seen(entries: DataFrame) -> DataFrame:
    """The earliest entry of each device on each day."""
    order = [c for c in ("ts", "page_id", "page_item", "user_id") if c in entries.columns]
    return pick_one(entries, DAY_KEY, order)


def first_hours(entries: DataFrame) -> DataFrame:
    """(mid, dt, hr) of each device's first entry: all the hourly report needs, from one hash aggregate."""
    first = entries.groupBy(*DAY_KEY).agg(F.min("ts").alias("ts"))
    return first.select(*DAY_KEY, hour_text(F.col("ts")).alias("hr"))


def unseen(entries: DataFrame, seen: DataFrame) -> DataFrame:
    """Entries of devices not yet stored for that day."""
    return entries.join(seen.select(*DAY_KEY), DAY_KEY, "left_anti")


def dau_enriched(
    first: DataFrame, users: DataFrame, provinces: DataFrame, as_of=None, strict: bool = False, keep_found: bool = False
) -> DataFrame:
    """First entries with their user and province columns."""
    with_user = enrich_user(first, users, as_of, strict, keep_found)
    return enrich_province(with_user, provinces, strict=strict, keep_found=keep_found)


def dau_document(enriched: DataFrame) -> DataFrame:
    """The 23 columns of the daily-active document."""
    extra = T.StructType([f for f in DAU_INFO if f.name not in PAGE_LOG.names])
    source = enriched.withColumn("user_age", F.col("user_age").cast("string")).alias("p")
    return source.select(*overlay(DAU_INFO, [("p", PAGE_LOG), ("p", extra)]))


def dau_wide(first: DataFrame, users: DataFrame, provinces: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    return dau_document(dau_enriched(first, users, provinces, as_of, strict))
