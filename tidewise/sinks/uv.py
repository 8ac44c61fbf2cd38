"""The devices' numbers and the days' bitmaps, derived from the page records by day.

Run it for the days that got pages since: ``<path>/devices`` only ever grows, so a number stays its device's for good, and a
day's bitmaps below ``<path>/days`` are replaced. A run that breaks off between the two leaves devices that have a number
and no bit yet; the next one sets it. One run at a time.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import uv
from ..schemas import DEVICE_BITS, DEVICES, PAGE_DAY
from .days import read_days, write_days
from .upsert import read_or_empty


def add_days(spark: SparkSession, pages: str, path: str, days: Sequence[str]) -> None:
    """Number the devices that are new in these days' pages, and write the days' bitmaps."""
    rows = read_days(spark, pages, PAGE_DAY, days).select("dt", "mid", "is_new")
    known = devices(spark, path)
    run = f"run-{time.time_ns()}"
    found = f"{path}/found/{run}"
    uv.unnumbered(rows, known).write.parquet(found)
    last = known.agg(F.max("number")).first()[0] or 0
    fresh = spark.read.schema("mid STRING, place LONG").parquet(found)
    uv.numbered(fresh, last).write.parquet(f"{path}/devices/_run={run}")
    write_days(uv.day_bitmaps(rows, devices(spark, path)), f"{path}/days", "day")


def devices(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/devices", DEVICES).select(*DEVICES.names)


def bitmaps(spark: SparkSession, path: str, days: Sequence[str]) -> DataFrame:
    return read_days(spark, f"{path}/days", DEVICE_BITS, days)
