"""Rows filed by day: an append-only table for what is read by period.

Layout: ``<path>/dt=<day>/_batch=<writer>-<n>/``. A batch writes below its own folders and a replay replaces them; a
reader opens the folders of the days it asks for and no others.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY, BATCH = "dt", "_batch"


def days_up_to(day: str, days: int) -> list[str]:
    """``days`` days, the last of which is ``day``."""
    last = datetime.date.fromisoformat(day)
    return [str(last - datetime.timedelta(days=n)) for n in range(days)]


def write_days(rows: DataFrame, path: str, batch: str) -> None:
    """Write one batch; rows without a day are left out."""
    (
        rows.where(F.col(DAY).isNotNull())
        .withColumn(BATCH, F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH)
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str]) -> DataFrame:
    """The rows of some days, with ``dt``; days that have no folder give none."""
    fields = [f for f in schema if f.name != DAY]
    full = T.StructType([*fields, T.StructField(DAY, T.StringType()), T.StructField(BATCH, T.StringType())])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [folder for folder in (f"{path}/{DAY}={day}" for day in dict.fromkeys(days)) if files.exists(hadoop(folder))]
    if not there:
        return spark.createDataFrame([], full).drop(BATCH)
    return spark.read.schema(full).option("basePath", path).parquet(*there).drop(BATCH)
