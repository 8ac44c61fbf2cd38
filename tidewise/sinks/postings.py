"""Term postings of the order documents by day: what a search needs of a term, without reading the texts.

``<path>/postings/dt=<day>/_run=<n>/_bucket=<n>-<b>/`` has a row (term, detail_id, tf, length) for each term of each
document, the terms of a bucket in order; ``<path>/stats/dt=<day>/`` the number of the day's named documents and of their
terms, and the run that readers take. Run ``add_days`` for the days whose documents have changed: what it writes counts
once its statistics are there, and the run before stays for searches that have begun.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokens
from ..schemas import POSTING, POSTING_STATS
from .days import read_days, write_days
from .upsert import bucket_of

#: Folders of a day, and files that a bucket is cut into, so that a term of all documents is not one task's alone.
BUCKETS, SLICES = 64, 4


def add_days(docs: DataFrame, path: str, cjk: bool = False) -> None:
    """Write the postings of whole days from their current documents (detail_id, sku_name, dt)."""
    spark, run = docs.sparkSession, str(time.time_ns())
    named = docs.where(F.col("sku_name").isNotNull()).select("dt", "detail_id", tokens(F.col("sku_name"), cjk).alias("terms"))
    named = named.withColumn("length", F.size("terms").cast("long"))
    filed = counted(named).withColumn("_bucket", bucket_of(F.col("term"), BUCKETS)).withColumn("_run", F.lit(run))
    slice_ = F.pmod(F.xxhash64("detail_id"), F.lit(SLICES))
    ordered = filed.repartition("dt", "_bucket", slice_).sortWithinPartitions("dt", "_bucket", "term", "detail_id")
    ordered.write.mode("append").partitionBy("dt", "_run", "_bucket").parquet(f"{path}/postings")
    stats = named.groupBy("dt").agg(F.count(F.lit(1)).alias("docs"), F.sum("length").alias("terms"))
    write_days(stats.withColumn("run", F.lit(run)).coalesce(1), f"{path}/stats", "day")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    top = hadoop(f"{path}/postings")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for day in files.listStatus(top) if files.exists(top) else []:
        runs = sorted((s.getPath() for s in files.listStatus(day.getPath())), key=lambda p: p.getName()) if day.isDirectory() else []
        for old in runs[:-2] if runs and runs[-1].getName() == f"_run={run}" else []:
            files.delete(old, True)


def counted(named: DataFrame) -> DataFrame:
    """(dt, term, detail_id, tf, length) of documents with their ``terms``.

    A document is one row, so its terms are counted within it: grouping would hold every posting and send it twice.
    """
    times = F.transform(
        F.array_distinct("terms"), lambda t: F.struct(t.alias("term"), F.size(F.filter("terms", lambda u: u == t)).cast("long").alias("tf"))
    )
    return named.select("dt", "detail_id", "length", F.inline(times)).select("dt", "term", "detail_id", "tf", "length")


def of_terms(spark: SparkSession, path: str, day: str, terms: Sequence[str]) -> DataFrame:
    """The day's postings of some terms, from their folders alone."""
    held = stats(spark, path, day).first()
    if held is None or not terms:
        return spark.createDataFrame([], POSTING)
    one = spark.sql("SELECT 1 AS one")
    labels = one.select(F.array(*[bucket_of(F.lit(t), BUCKETS) for t in terms]).alias("of")).first()["of"]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f"{path}/postings/dt={day}/_run={held['run']}/_bucket={b}" for b in dict.fromkeys(labels)]
    there = [f for f in folders if files.exists(hadoop(f))]
    if not there:
        return spark.createDataFrame([], POSTING)
    full = T.StructType([*POSTING.fields, *[T.StructField(n, T.StringType()) for n in ("dt", "_run", "_bucket")]])
    rows = spark.read.schema(full).option("basePath", f"{path}/postings").parquet(*there)
    return rows.where(F.col("term").isin(*terms)).select(*POSTING.names)


def stats(spark: SparkSession, path: str, day: str) -> DataFrame:
    return read_days(spark, f"{path}/stats", POSTING_STATS, [day])
