"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings the pipeline is written for. Dates and hours are formatted in the
# session time zone, so it is pinned rather than inherited from the host.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One store per join partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # State and its change log hold every row of some days: packed, in blocks large enough to pack well.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "64",
    # Counting the rows of a store asks it for each key before it is written.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # A batch's shuffle files go with it, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A landed file is read by as many tasks as its size asks for, however few files a topic came in.
    "spark.sql.files.maxPartitionBytes": "32m",
    # De-duplication and inner joins emit nothing when state expires, so a batch
    # without input would only evict; the next one with input does that too.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def build_session(app: str = "tidewise", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_session(
    spark: SparkSession, shuffle_partitions: int | None = None, idle_batches: bool = False
) -> SparkSession:
    """A sibling session with the streaming settings; the caller's own settings stay as they are.

    The number of state partitions is fixed when a checkpoint is created, so a
    job on a cluster passes the value it was sized for. ``idle_batches`` is for
    jobs that emit what the passing of time completes.
    """
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())
    parts = shuffle_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", str(parts))
    return session


@functools.lru_cache(maxsize=None)
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tidewise-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session may do without that setting; on a cluster a
    machine-local folder would not be seen by the executors.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root(context.applicationId)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
