"""Array helpers shared by the corpus operators: hashes, chunks of documents, scratch tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from ..session import scratch_dir

# Odd multipliers of the hashes below.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

#: Rows of whole texts that go to Python at once at most; Spark's setting for it and what it is by itself.
BATCH_ROWS = 500
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"

#: Bytes of rows, of about a megabyte each, that a piece of a stored table of such rows holds. A reader has one piece in memory.
ROW_GROUP = 2 << 20

CHUNK = 1 << 18  # bytes or characters that one round of array work takes


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX[1])
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


@functools.lru_cache(maxsize=4)
def _powers(length: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to ``length`` (an odd base has an inverse)."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for factor in (base, inverse):
        steps = np.full(length + 1, factor, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class PrefixHash:
    """Polynomial prefix hashes of a byte buffer: the hash of any slice in O(1), vectorised."""

    def __init__(self, data: np.ndarray, base: int = BASE) -> None:
        size = 1 << max(16, int(len(data)).bit_length())
        self.power, self.inverse = _powers(size, base)
        terms = (data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)]
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [start, end): equal slices of equal length have equal hashes wherever they lie."""
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all slices of one length."""
        n = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:n]) * self.inverse[:n]


def chunks(sizes: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive documents of about ``limit`` together, one at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def own_session(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """The same rows in a session of the operator's own, where a batch that goes to Python holds at most ``rows`` rows.

    Spark's 10 000 rows of whole texts are tens of megabytes for each buffer and task, outside the heap. The
    caller's session stays as it is; if it has smaller batches already, it is used itself.
    """
    spark = df.sparkSession
    if 0 < int(spark.conf.get(_BATCH, _DEFAULT)) <= rows:
        return df
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(_BATCH, str(rows))
    view = f"rows_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        return own.table(f"{own.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def free_name(df: DataFrame, name: str) -> str:
    """A column name for the operator's own use that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while (name := f"_{name}").lower() in taken:
        pass
    return name


def stored(df: DataFrame, label: str, compression: str | None = None, large_rows: bool = False) -> DataFrame:
    """Cut the lineage with a table in the folder all executors share.

    ``large_rows`` are written in pieces of ``ROW_GROUP``. By itself the writer looks at its size every hundred rows, and
    whoever reads then holds a file's rows together, however much went into the file.
    """
    path = scratch_dir(df.sparkSession, label)
    pieces_of = {"parquet.block.size": str(ROW_GROUP), "parquet.page.size.row.check.min": "1"} if large_rows else {}
    df.write.options(**pieces_of).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table of ``stored`` once everything that is read from it is stored itself."""
    files, spark = table.inputFiles(), table.sparkSession
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pieces(total: int, each: int) -> int:
    """How many parts of about ``each`` hold ``total``."""
    return max(1, -(-int(total) // each))
