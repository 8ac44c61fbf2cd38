"""Exact top-k by inner product: the threshold algorithm over sorted lists of every dimension.

Vectors are dealt to cells by their best pivot, cells to shards. A shard keeps one list per dimension, sorted by value.
For a query, each list is read from the end that helps it; a vector that turns up in any list gets its whole score. No
unread vector can score more than the sum of the lists' next values times the query, and reading stops when that bound
is below the kth result (at equality it goes on, for ties). A query first searches the shard of its own cell; its kth
score there is the result to beat in all others, most of which end at their first bound.

Vectors null, empty, of another length than most, or holding null or non-finite components take no part; nor do rows
without an id. Equal scores go to smaller ids; rows of one id are separate candidates, of which
none is a result of their own id's query (asked once, by the smallest vector). Fewer than k candidates give all.
Columns other than id and vector are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors
from .arrays import stored

FOUND = "query_id long, vec_id long, score double"
FIRST_DEPTH = 16


class Lists:
    """One shard: its vectors and, per dimension, their order by value."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.order = np.argsort(points, axis=0, kind="stable")
        self.values = np.take_along_axis(points, self.order, axis=0)

    def search(self, query: np.ndarray, first_ids: np.ndarray, k: int, beat: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best (ties to the smaller first id) among those that reach ``beat``."""
        n = len(self.points)
        used = np.flatnonzero(query)
        weight, rising = query[used], query[used] < 0
        seen = np.zeros(n, dtype=bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            # The next value of each list bounds every vector not yet read in any.
            place = np.where(rising, depth, n - 1 - depth)
            bound = float((self.values[place, used] * weight).sum())
            if bound < beat or (len(rows) >= k and bound < scores[-1]):
                break
            stop = min(n, depth + step)
            down = self.order[n - stop : n - depth, used[~rising]]
            new = np.zeros(n, dtype=bool)
            new[down.ravel()] = True
            new[self.order[depth:stop, used[rising]].ravel()] = True
            if not len(used):
                new[:] = True
            new &= ~seen
            seen |= new
            at = np.flatnonzero(new)
            value = self.points[at] @ query
            good = value >= beat
            rows, scores = np.concatenate((rows, at[good])), np.concatenate((scores, value[good]))
            top = np.lexsort((first_ids[rows], -scores))[:k]
            rows, scores = rows[top], scores[top]
            if seen.all():
                break
            depth, step = stop, step * 2
        return rows, scores


def _kernel(k: int):
    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        ids = points.column("ids").to_pylist()
        if not ids or not len(queries):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        lists = Lists(vectors.matrix(points.column("v")))
        first = np.array([i[0] for i in ids], dtype=np.int64)
        own = [np.array(i, dtype=np.int64) for i in ids]
        asked = vectors.matrix(queries.column("v"))
        names, beats = queries.column("query_id").to_pylist(), queries.column("beat").to_pylist()
        found = []
        for name, query, beat in zip(names, asked, beats):
            # One more than k, as the query itself may be among them.
            rows, scores = lists.search(query, first, k + 1, -np.inf if beat is None else beat)
            found += vectors.expand(scores, [own[r] for r in rows], name, k)
        columns = list(zip(*found)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    return run


def _cells(batches, pivots: np.ndarray):
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = (vectors.matrix(batch.column("v")) @ pivots.T).argmax(axis=1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])


def top_k(df: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding", transform=None) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest inner products of every query row with all other rows.

    ``is_query`` is a condition on ``id``; ``transform`` maps each component (a column function). Scores are exact as
    long as the sums are integers below 2**53.
    """
    rows = vectors.valid(df, id_column, vector)
    if transform is not None:
        rows = rows.select("id", F.transform("v", transform).cast("array<double>").alias("v"))
    rows = stored(rows, "topk-rows")
    points = stored(vectors.distinct(rows, k), "topk-points")
    chosen = vectors.sample(points)
    if not len(chosen):
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivots = chosen[: max(1, min(vectors.CELLS, points.count() * 2 // vectors.SHARD_ROWS))]
    shared = df.sparkSession.sparkContext.broadcast(pivots)
    with_cell = points.mapInArrow(lambda it: _cells(it, shared.value), "ids array<long>, v array<double>, cell int")
    sharded, parts = vectors.shards_of(stored(with_cell, "topk-cells"))
    sharded = stored(sharded.select("ids", "v", "shard"), "topk-shards")
    asked = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v")).select(F.array("id").alias("ids"), "v")
    asked = asked.mapInArrow(lambda it: _cells(it, shared.value), "ids array<long>, v array<double>, cell int")
    count = rows.where(is_query).count()
    # A query's cell may hold no vector of its own kind; then it starts in the first shard.
    home = F.create_map(*[F.lit(x) for cell, (first, _) in parts.items() for x in (cell, first)])
    asked = asked.select(F.col("ids")[0].alias("query_id"), "v", F.coalesce(home[F.col("cell")], F.lit(0)).alias("home"))
    queries = stored(asked, "topk-queries")
    near = vectors.meet(sharded, queries.select(F.col("home").alias("shard"), "query_id", "v", F.lit(None).cast("double").alias("beat")), _kernel(k), FOUND, count)
    near = stored(near, "topk-near")
    beat = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("beat"))
    total = sum(n for _, n in parts.values())
    onward = queries.join(beat, "query_id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(total - 1))))
    onward = onward.where("shard != home").select("shard", "query_id", "v", "beat")
    far = vectors.meet(sharded, onward, _kernel(k), FOUND, count)
    return vectors.best(near.unionByName(far), k)
