"""Approximate nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

Lists are the cells of k-means centroids of directions (fitted on at most ``vectors.SAMPLE`` vectors; every vector is put
in a list), split by length, half a power of two each, so that one long vector has a list of its own and leaves the others
alone. A query probes lists in order of the best score that they promise, until these hold the share ``probes`` of all
vectors. Within a list, vectors are measured in units of the longest, and a coordinate that fills each up to it
turns the largest inner product into the smallest distance to the query's direction; a fixed random rotation then
spreads each vector's energy evenly, so that a distance in the first d of D dimensions, times D/d, estimates the whole.
Lists are scanned in blocks of ``BLOCK`` rotated dimensions, for all queries that probe one together; after each block,
candidates whose partial distance is too large for the kth distance so far (a test of ``EPSILON`` deviations)
are abandoned. What survives is scored in double precision on the original vectors.

Small lists share a shard, long ones are many. Each query first scans what it probes in the shard of its best list; the kth
score found there is what candidates in its other shards have to beat. Which vectors take part, ties and repeated ids: as in
``topk``, and zero vectors take no part. Columns other than id and vector are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors
from .arrays import pieces, stored

FOUND = "query_id long, vec_id long, score double"
BLOCK, EPSILON = 16, 3.0
#: Share of the vectors whose lists a query probes, and so many lists at least; lists of one length at most.
PROBES, LEAST_PROBES, LISTS = 0.75, 8, 1024
#: Deviations above its middle at which a list's best score is expected.
PROMISE = 3.0
#: Pairs of queries and candidates that are measured at once, and the share of them left at which they are taken singly.
PAIRS, SINGLY = 1 << 20, 0.2
#: Distances are between unit vectors; what rounding may add.
ROUNDING = 1e-9
ROUNDS = 12
SEED = 7


def rotation(dimension: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def centroids(points: np.ndarray, count: int) -> np.ndarray:
    """k-means from evenly chosen starts; a centroid that loses all its points stays."""
    center = points[np.linspace(0, len(points) - 1, count).astype(int)].copy()
    for _ in range(ROUNDS):
        cell = _distances(points, center).argmin(axis=1)
        for i in np.unique(cell):
            center[i] = points[cell == i].mean(axis=0)
    return center


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]


def lengths(v: np.ndarray) -> np.ndarray:
    """Lengths of vectors whose squares may be out of range."""
    most = np.abs(v).max(axis=1)
    return most * np.sqrt(((v / most[:, None]) ** 2).sum(axis=1))


class Cells:
    """Which cell a vector belongs to: its direction's centroid and its length."""

    #: Halves of a power of two that lengths of doubles can differ by, with room.
    CLASSES = 1 << 13

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.center = centroids(sample / lengths(sample)[:, None], lists)

    def of(self, v: np.ndarray) -> np.ndarray:
        size = lengths(v)
        near = _distances(v / size[:, None], self.center).argmin(axis=1)
        return near * self.CLASSES + np.floor(2 * np.log2(size) + 0.5).astype(np.int64) + self.CLASSES // 2


class Space:
    """The lists with their numbers of vectors and the shards they are in."""

    def __init__(self, cells: Cells, counts: dict[int, int], parts: dict[int, tuple[int, int]], probes: float) -> None:
        self.number = np.array(sorted(counts), dtype=np.int64)
        self.rows = np.array([counts[i] for i in self.number.tolist()], dtype=np.int64)
        self.first, self.parts = np.array([parts[i] for i in self.number.tolist()], dtype=np.int64).T
        self.middle = cells.center[self.number // Cells.CLASSES]
        self.reach = 2.0 ** ((self.number % Cells.CLASSES - Cells.CLASSES // 2 + 0.5) / 2)
        dimension = self.middle.shape[1]
        around = np.sqrt(np.maximum(1 - (self.middle**2).sum(axis=1), 0.0))
        self.above = PROMISE * around / np.sqrt(dimension)
        self.turn, self.probes = rotation(dimension + 1), probes

    def probed(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query's direction the lists in order of promise, and how many of them it probes."""
        order = np.argsort(-(unit @ self.middle.T + self.above) * self.reach, axis=1, kind="stable")
        before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        wanted = (before < self.probes * self.rows.sum()).sum(axis=1)
        return order, np.minimum(np.maximum(wanted, LEAST_PROBES), len(self.number))

    def shards(self, unit: np.ndarray) -> list[list[int]]:
        """The shards of each query's lists, that of the most promising one first."""
        out = []
        for order, n in zip(*self.probed(unit)):
            mine = order[:n]
            all_of = np.repeat(self.first[mine], self.parts[mine])
            step = np.arange(len(all_of)) - np.repeat(np.cumsum(self.parts[mine]) - self.parts[mine], self.parts[mine])
            out.append(list(dict.fromkeys((all_of + step).tolist())))
        return out


def scan(queries: np.ndarray, blocks: list[np.ndarray], k: int, beat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row of a list) of rows that may be among a query's k nearest; ``blocks`` are the list's columns in blocks.

    ``beat`` holds for each query a squared distance that k others already have. Rows are taken in portions, the first of
    which sets the kth distance for the rest.
    """
    size, width = len(blocks[0]), sum(b.shape[1] for b in blocks)
    asked, rows, far = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    beat, at, portion = beat.copy(), 0, max(4 * k, 128)
    while at < size:
        stop, done, single = min(size, at + portion), 0, False
        whole = np.zeros((len(queries), stop - at))
        for i, block in enumerate(blocks):
            here, there = queries[:, done : done + block.shape[1]], block[at:stop]
            done += block.shape[1]
            # The last block gives whole distances, to be compared without the test's margin (but for rounding).
            margin = 1 + EPSILON / np.sqrt(done) if i < len(blocks) - 1 else 1.0
            limit = (beat * margin**2 + ROUNDING) * (done / width)
            if single:
                step = there[r] - here[q]
                f = f + np.einsum("ij,ij->i", step, step)
                alive = f <= limit[q]
                q, r, f = q[alive], r[alive], f[alive]
            else:
                whole += _distances(here, there)
                alive = whole <= limit[:, None]
                if i == len(blocks) - 1 or np.count_nonzero(alive) < SINGLY * alive.size:
                    single = True
                    q, r = np.nonzero(alive)
                    f = whole[q, r]
        asked, rows, far = np.concatenate((asked, q)), np.concatenate((rows, r + at)), np.concatenate((far, f))
        kept, kth = _first(asked, far, k)
        beat = np.minimum(beat, np.append(kth, np.full(len(beat) - len(kth), np.inf)) + ROUNDING)
        asked, rows, far = asked[kept], rows[kept], far[kept]
        at, portion = stop, portion * 2
    return asked, rows


def _first(group: np.ndarray, value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each group's k + 1 smallest values and those equal to the last, by group and value; and that last one (or inf)."""
    order = np.lexsort((value, group))
    starts = np.searchsorted(group[order], np.arange(int(group.max(initial=-1)) + 2))
    last = np.full(len(starts) - 1, np.inf)
    full = np.flatnonzero(np.diff(starts) > k)
    last[full] = value[order][starts[full] + k]
    return order[value[order] <= last[group[order]]], last


def _search(points: pa.Table, queries: pa.Table, space: Space, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, point) of a shard that may be among a query's k best, and their scores."""
    original, cell = vectors.matrix(points.column("v")), points.column("cell").to_numpy()
    asked = vectors.matrix(queries.column("v"))
    size, norm = lengths(original), lengths(asked)
    unit = asked / norm[:, None]
    spun = np.column_stack((unit, np.zeros(len(unit)))) @ space.turn
    order, count = space.probed(unit)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
    worst = queries.column("worst").to_numpy().astype(float)
    q, p, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for number in np.unique(cell).tolist():
        place, mine = int(np.searchsorted(space.number, number)), np.flatnonzero(cell == number)
        longest = size[mine].max()
        scaled = original[mine] / longest
        rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0.0))
        turned = np.column_stack((scaled, rest)) @ space.turn
        blocks = [np.ascontiguousarray(turned[:, i : i + BLOCK]) for i in range(0, turned.shape[1], BLOCK)]
        probing = np.flatnonzero(rank[:, place] < count)
        beat = 2 - 2 * (worst[probing] / norm[probing] / longest)
        # Nothing to beat yet, or a score out of range: all are looked at.
        beat = np.where(np.isfinite(beat), np.maximum(beat, 0.0), np.inf)
        step = max(1, PAIRS // len(mine))
        for i in range(0, len(probing), step):
            some = probing[i : i + step]
            found_q, found_p = scan(spun[some], blocks, k + 1, beat[i : i + step])
            found_q, found_p = some[found_q], mine[found_p]
            q, p = np.concatenate((q, found_q)), np.concatenate((p, found_p))
            score = np.concatenate((score, (original[found_p] * asked[found_q]).sum(axis=1)))
        kept, last = _first(q, -score, k)
        q, p, score = q[kept], p[kept], score[kept]
        worst[: len(last)] = np.fmax(worst[: len(last)], -last)
    return q, p, score


def _kernel(space, k: int):
    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        q = ids = np.zeros(0, np.int64)
        score = np.zeros(0)
        if len(points) and len(queries):
            with np.errstate(over="ignore", invalid="ignore"):
                q, p, score = _search(points, queries, space.value, k)
            own = [np.array(i, dtype=np.int64) for i in points.column("ids").to_pylist()]
            many = np.array([len(own[i]) for i in p.tolist()], dtype=np.int64)
            ids = np.concatenate([ids, *(own[i] for i in p.tolist())])
            q = queries.column("query_id").to_numpy()[np.repeat(q, many)]
            score = np.repeat(score, many)
            other = ids != q
            q, ids, score = q[other], ids[other], score[other]
            order = np.lexsort((ids, -score, q))
            q, ids, score = q[order], ids[order], score[order]
            top = np.arange(len(q)) - np.searchsorted(q, q) < k
            q, ids, score = q[top], ids[top], score[top]
        return pa.table({"query_id": q, "vec_id": ids, "score": score})

    return run


def _with_cells(batches, cells):
    for batch in batches:
        if batch.num_rows:
            cell = pa.array(cells.value.of(vectors.matrix(batch.column("v"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], names=[*batch.schema.names, "cell"])


def _with_shards(batches, space):
    for batch in batches:
        if batch.num_rows:
            v = vectors.matrix(batch.column("v"))
            shards = pa.array(space.value.shards(v / lengths(v)[:, None]), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, shards], names=[*batch.schema.names, "shards"])


def shards_of(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Each cell's first shard and how many it has: long cells have shards of their own, others share one of about ``SHARD_ROWS``."""
    parts, shard, room = {}, 0, vectors.SHARD_ROWS
    for cell, rows in sorted(counts.items()):
        if rows > room and room < vectors.SHARD_ROWS:
            shard, room = shard + 1, vectors.SHARD_ROWS
        parts[cell] = (shard, pieces(rows, vectors.SHARD_ROWS))
        if rows > room:
            shard, room = shard + parts[cell][1], vectors.SHARD_ROWS
        else:
            room -= rows
    return parts


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding", probes: float = PROBES
) -> DataFrame:
    """query_id, rank, vec_id, score of about the k largest inner products of every query row with all other rows."""
    rows = stored(vectors.valid(df, id_column, vector, zero=False), "ann-rows")
    points = stored(vectors.distinct(rows, k), "ann-points")
    chosen = vectors.sample(points)
    if not len(chosen):
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    context = df.sparkSession.sparkContext
    lists = max(1, min(LISTS, int(np.sqrt(points.count())), len(chosen) // 4))
    cells = Cells(chosen, lists)
    shared = context.broadcast(cells)
    dealt = stored(points.mapInArrow(lambda it: _with_cells(it, shared), "ids array<long>, v array<double>, cell long"), "ann-cells")
    # At most LISTS rows for each length that occurs.
    counts = {r["cell"]: r["count"] for r in dealt.groupBy("cell").count().collect()}
    parts = shards_of(counts)
    space = context.broadcast(Space(cells, counts, parts, probes))
    table = F.create_map(*[F.lit(x) for cell, (first, n) in parts.items() for x in (cell, F.struct(F.lit(first).alias("first"), F.lit(n).alias("n")))])
    place = table[F.col("cell")]
    spread = F.pmod(F.xxhash64(F.col("ids")[0]), place["n"].cast("long")).cast("int")
    sharded = stored(dealt.withColumn("shard", place["first"] + spread), "ann-shards")
    asked = rows.where(is_query).groupBy(F.col("id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = stored(asked.mapInArrow(lambda it: _with_shards(it, space), "query_id long, v array<double>, shards array<int>"), "ann-queries")
    number = asked.count()
    home = asked.select(F.col("shards")[0].alias("shard"), "query_id", "v", F.lit(None).cast("double").alias("worst"))
    near = stored(vectors.meet(sharded, home, _kernel(space, k), FOUND, number), "ann-near")
    worst = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("worst"))
    onward = asked.join(worst, "query_id", "left").select(F.posexplode("shards").alias("n", "shard"), "query_id", "v", "worst").where("n > 0").drop("n")
    far = vectors.meet(sharded, onward, _kernel(space, k), FOUND, number)
    return vectors.best(near.unionByName(far), k)
