"""Vectors for the search operators: valid rows, distinct vectors, shards, and queries against shards in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import pieces

#: Rows of a shard, and queries that meet a shard in one call.
SHARD_ROWS, QUERY_ROWS = 4096, 4096
#: Vectors that pivots or centroids are chosen from, and at most so many of them.
SAMPLE, CELLS = 8192, 256

Kernel = Callable[[pa.Table, pa.Table], pa.Table]


def valid(df: DataFrame, id_column: str, vector: str, zero: bool = True) -> DataFrame:
    """(id, v) of the rows that take part: an id, no null or non-finite component, the most frequent length; with
    ``zero=False`` at least one component that is not zero. Empty vectors take no part."""
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where((F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def distinct(rows: DataFrame, k: int) -> DataFrame:
    """(ids, v): each distinct vector once with its k + 1 smallest ids. More of a vector's copies can never be among the
    k best of a query, not even when the query is one of them, and a task sends no more of them to the shuffle."""
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("ids", "v")


def sample(points: DataFrame) -> np.ndarray:
    """At most SAMPLE vectors, those of smallest hash of their first id."""
    got = points.orderBy(F.xxhash64(F.lit("vectors"), F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE).select("v").toArrow()
    return matrix(got.column("v"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    values = [part.flatten().to_numpy(zero_copy_only=False) for part in parts if len(part)]
    return np.concatenate(values).reshape(len(column), -1) if values else np.zeros((0, 1))


def shards_of(cells: DataFrame) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Split cells into shards of about SHARD_ROWS by a hash, so that a crowded cell is many shards.

    Returns the rows with ``shard`` and, of each cell, its first shard and their number.
    """
    counts = sorted(cells.groupBy("cell").count().collect())
    parts, at = {}, 0
    for row in counts:
        parts[row["cell"]] = (at, pieces(row["count"], SHARD_ROWS))
        at += parts[row["cell"]][1]
    if not parts:
        return cells.withColumn("shard", F.lit(0)), parts
    table = F.create_map(*[F.lit(x) for cell, (first, n) in parts.items() for x in (cell, first * (1 << 20) + n)])
    code = table[F.col("cell")]
    part = F.pmod(F.xxhash64(F.col("ids")[0]), F.pmod(code, F.lit(1 << 20)).cast("long"))
    return cells.withColumn("shard", (F.floor(code / (1 << 20)) + part).cast("int")), parts


def meet(points: DataFrame, queries: DataFrame, kernel: Kernel, schema: str, query_count: int) -> DataFrame:
    """Run ``kernel`` on every shard's points and the queries sent to it, QUERY_ROWS of them at a time."""
    groups = pieces(query_count, QUERY_ROWS)
    left = points.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(kernel, schema)


def expand(scores: np.ndarray, ids: list[np.ndarray], query_id: int, k: int) -> list[tuple[int, int, float]]:
    """The k best (query, id, score) of some distinct vectors, ties to smaller ids, without the query itself."""
    rows = sorted((-s, i) for s, own in zip(scores.tolist(), ids) for i in own.tolist() if i != query_id)
    return [(query_id, i, -s) for s, i in rows[:k]]


def best(found: DataFrame, k: int) -> DataFrame:
    """Rank each query's results: query_id, rank, vec_id, score."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


