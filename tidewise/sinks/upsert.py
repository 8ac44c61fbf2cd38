"""Keyed document tables on plain Parquet: idempotent upsert, current view, compaction.

Layout: ``<path>/<part>=<value>/_batch=<writer>-<n>/``. A batch writes only its
own folders (so a write costs what the batch holds, not what the day holds, and
a replayed batch replaces exactly what it wrote before). A reader keeps, per
key, the row of the greatest version, of equal versions the one of the latest
batch; so a table does not depend on how a sequence of changes was cut into
batches. ``compact`` folds a partition's batches into one.
"""

from __future__ import annotations

import contextlib
import time
from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import pick_one

_SEQ, _BATCH, _VERSION, _BUCKET = "_seq", "_batch", "_version", "_bucket"
#: A file of this name in a batch's folder says that the batch has been folded, and when.
_FOLDED = "_folded-"
_LATEST = [_VERSION, _SEQ]
#: Folders that a task may write side by side; with more it sorts what is left by folder.
OPEN_FOLDERS = 16


def upsert(
    docs: DataFrame,
    path: str,
    key: str,
    part: str,
    batch: str,
    order: Sequence[str] = (),
    seq: int | None = None,
    version: Sequence[str] = (),
    keep: Sequence[str] | None = None,
    buckets: int = 0,
    unique: bool = False,
) -> None:
    """Write one batch of documents. Within it, the greatest row by ``order`` stands for its key.

    ``version`` names the columns that rank a key's rows across batches, in
    their order; without it the latest batch wins. ``keep`` narrows what is stored;
    ``buckets`` files it by parts of the keys as well. ``unique`` says that the batch has one row of each key already,
    as what ``order_wide`` or ``read_current`` returns: it is then written as it is, with no shuffle.
    A failed write fails the batch, so nothing after it is committed.
    """
    one = docs if unique else pick_one(docs, [part, key], list(order or version), latest=True)
    ranked = one.withColumn(_VERSION, _version_text(one, version))
    rows = ranked if keep is None else ranked.select(*keep, _VERSION)
    stamped = rows.withColumn(_SEQ, F.lit(seq if seq is not None else time.time_ns())).withColumn(_BATCH, F.lit(batch))
    _write(stamped, path, key, part, buckets)


def _write(rows: DataFrame, path: str, key: str, part: str, buckets: int) -> None:
    """Replace the folders of the batches that ``rows`` name. With buckets, a folder's rows meet before, so it gets one file."""
    levels = [part, _BUCKET, _BATCH] if buckets else [part, _BATCH]
    if buckets:
        rows = rows.withColumn(_BUCKET, bucket_of(F.col(key), buckets)).repartition(part, _BUCKET)
    with _side_by_side(rows.sparkSession, 0 if buckets else OPEN_FOLDERS):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*levels).parquet(path)


@contextlib.contextmanager
def _side_by_side(spark: SparkSession, folders: int) -> Iterator[None]:
    """Let a task hold that many folders open, so that its rows, wide and many, need no sort by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(folders))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bucket_of(key: Column, buckets: int) -> Column:
    """The part of a table, ``<buckets>-<number>``, that a key is filed in."""
    return F.concat(F.lit(f"{buckets}-"), F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("string"))


def _version_text(docs: DataFrame, columns: Sequence[str]) -> Column:
    """The version columns as one text that sorts as they do: numbers (not negative) to full width, NULL first."""

    def text(name: str) -> Column:
        value = F.col(name).cast("string")
        padded = value if docs.schema[name].dataType == T.StringType() else F.lpad(value, 20, "0")
        return F.coalesce(padded, F.lit(""))

    return F.concat_ws("\x01", *[text(c) for c in columns]) if columns else F.lit("")


def _stored(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    part: str,
    values: Sequence[str] | None = None,
    buckets: Sequence[str] | None = None,
) -> DataFrame:
    """The stored rows; of the named partitions (and buckets) only, which then are the only folders listed."""
    if values is None:
        return read_or_empty(spark, path, _with_stamps(schema, part))
    return _of_folders(spark, path, schema, part, [f for v in values for f in _batches(spark, path, part, v, buckets)])


def _with_stamps(schema: T.StructType, part: str) -> T.StructType:
    fields = [f for f in schema if f.name != part]
    stamps = [T.StructField(_SEQ, T.LongType()), T.StructField(_VERSION, T.StringType())]
    return T.StructType([*fields, *stamps, T.StructField(part, T.StringType()), T.StructField(_BATCH, T.StringType())])


def _of_folders(spark: SparkSession, path: str, schema: T.StructType, part: str, folders: Sequence) -> DataFrame:
    full = _with_stamps(schema, part)
    if not folders:
        return _no_rows(spark, full)
    return spark.read.schema(full).option("basePath", path).parquet(*[f.toString() for f in folders])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _no_rows(spark, schema)


def _no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_current(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str,
    part: str,
    columns: Sequence[str] | None = None,
    only: DataFrame | None = None,
    values: Sequence[str] | None = None,
    buckets: int = 0,
    plain: bool = False,
) -> DataFrame:
    """The current document of every key. A filter on ``part`` prunes folders; ``values`` names them beforehand.

    ``columns`` narrows what is read and compared; the key and partition always
    come along. ``only`` (one column, named as the key) narrows the keys before
    the latest row is looked for, so a batch asks for its own keys alone; with
    ``buckets`` (as the table was written) only folders that may have them are
    opened. At most that many short names reach the driver. ``plain``, over whole tables:
    a partition that holds one batch is scanned as it is, as in ``read_days``.
    """
    if plain and only is None and values is None and (alone := _of_one_batch(spark, path, part)):
        names = schema.names if columns is None else [part, key, *(c for c in columns if c not in (part, key))]
        scanned = _of_folders(spark, path, schema, part, list(alone.values())).select(*names)
        others = [spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}={v}") for v in parts_of(spark, path, part) if v not in alone]
        if not others:
            return scanned
        rows = _of_folders(spark, path, schema, part, others).select(*names, _SEQ, _VERSION)
        return scanned.unionByName(pick_one(rows, [part, key], _LATEST, latest=True).select(*names))
    wanted = [part, key, *(c for c in (columns or schema.names) if c not in (part, key))]
    asked = None
    if only is not None and buckets and values is not None:
        asked = [r[0] for r in only.select(bucket_of(F.col(key), buckets)).distinct().collect()]
    stored = _stored(spark, path, schema, part, values, asked).select(*wanted, _SEQ, _VERSION)
    if only is not None:
        stored = stored.join(only, key, "left_semi")
    current = pick_one(stored, [part, key], _LATEST, latest=True).drop(_SEQ, _VERSION)
    return current.select(*(schema.names if columns is None else wanted))


def read_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str,
    part: str,
    values: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The current documents of the named partitions, for reports.

    Keys are unique within a batch, so a partition that holds one batch (a
    compacted day) is scanned as it is, without the shuffle that finds the
    latest row; only the others go through it.
    """
    # Listed once: what comes in between must not turn one folder into two that nobody merges.
    folders = {v: _batches(spark, path, part, v) for v in values}
    single = [f for of in folders.values() if len(of) == 1 for f in of]
    several = [f for of in folders.values() if len(of) > 1 for f in of]
    wanted = schema.names if columns is None else [part, key, *(c for c in columns if c not in (part, key))]
    plain = _of_folders(spark, path, schema, part, single).select(*wanted)
    if not several:
        return plain
    stored = _of_folders(spark, path, schema, part, several).select(*wanted, _SEQ, _VERSION)
    merged = pick_one(stored, [part, key], _LATEST, latest=True).select(*wanted)
    return plain.unionByName(merged) if single else merged


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _all_batches(spark: SparkSession, path: str, part: str, value: str, buckets: Sequence[str] | None = None) -> list[tuple]:
    """The batch folders of one partition, and of those folded already the time of it (else None).

    ``buckets`` leaves out the other buckets of the same number.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}={value}")
    files = _files(spark, top)

    def below(folder) -> list:
        return [s.getPath() for s in files.listStatus(folder)] if files.exists(folder) else []

    def other(name: str) -> bool:
        label = name.removeprefix(f"{_BUCKET}=")
        return buckets is not None and label not in buckets and label.split("-")[0] in {b.split("-")[0] for b in buckets}

    def listed() -> list:
        level = below(top)
        found = [p for p in level if p.getName().startswith(f"{_BATCH}=")]
        for bucket in (p for p in level if p.getName().startswith(f"{_BUCKET}=") and not other(p.getName())):
            found += [p for p in below(bucket) if p.getName().startswith(f"{_BATCH}=")]
        return found

    folded = {}
    for batch in listed():
        marks = [p.getName() for p in below(batch) if p.getName().startswith(_FOLDED)]
        folded[batch.toString()] = int(max(marks).removeprefix(_FOLDED)) if marks else None
    # Listed again after the marks: what a marked batch was folded into was there before its mark, so it is among these.
    return [(batch, folded.get(batch.toString())) for batch in listed()]


def parts_of(spark: SparkSession, path: str, part: str) -> list[str]:
    """The values that a table has partitions of, from one listing."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = _files(spark, top)
    names = [s.getPath().getName() for s in files.listStatus(top)] if files.exists(top) else []
    return sorted(n.removeprefix(f"{part}=") for n in names if n.startswith(f"{part}="))


def _of_one_batch(spark: SparkSession, path: str, part: str) -> dict:
    """The partitions that hold one batch, not cut into buckets, and its folder: one listing a partition."""
    found = {}
    for value in parts_of(spark, path, part):
        top = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}={value}")
        inside = [s.getPath() for s in _files(spark, top).listStatus(top)]
        if len(inside) == 1 and inside[0].getName().startswith(f"{_BATCH}="):
            found[value] = inside[0]
    return found


def _batches(spark: SparkSession, path: str, part: str, value: str, buckets: Sequence[str] | None = None) -> list:
    """The folders of the batches that are not folded yet; none where the partition does not exist."""
    return [folder for folder, folded in _all_batches(spark, path, part, value, buckets) if folded is None]


def stored_keys(
    spark: SparkSession, path: str, schema: T.StructType, key: str, part: str, values: Sequence[str] | None = None
) -> DataFrame:
    """The keys stored in each partition (or in the named ones), without duplicates."""
    return _stored(spark, path, schema, part, values).select(key, part).distinct()


def compact(
    spark: SparkSession, path: str, schema: T.StructType, key: str, part: str, value: str, grace: float = 0.0, buckets: int = 0
) -> None:
    """Fold one partition's batches into a single one, while others read and write it.

    Folders that were there at the start are folded; batches written meanwhile stay as they are. What is folded is marked,
    so that who comes later does not read it, and kept for ``grace`` seconds, so that who has listed it before finds it:
    longer than a query takes. A later call, or this one if ``grace`` is 0, removes it. Both forms side by side give the
    same rows, so a crash in between only leaves work to repeat. Without two batches in one place nothing is folded.
    """
    old = _batches(spark, path, part, value)
    if len(old) > len({f.getParent().toString() for f in old}):
        stamp = time.time_ns()
        rows = _of_folders(spark, path, schema, part, old).drop(_BATCH)
        folded = pick_one(rows, [part, key], _LATEST, latest=True).withColumn(_BATCH, F.lit(f"compact-{stamp}"))
        _write(folded, path, key, part, buckets)
        for folder in old:
            _files(spark, folder).create(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{_FOLDED}{stamp}")).close()
    for folder, since in _all_batches(spark, path, part, value):
        if since is not None and time.time_ns() - since >= grace * 1e9:
            _files(spark, folder).delete(folder, True)
