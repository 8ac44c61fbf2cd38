"""Exact and approximate search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.llm import ann, topk, vectors

def even():
    return F.col("id") % 4 == 0


def brute(rows: list[tuple], k: int, zero: bool = True) -> dict[int, list[tuple[int, float]]]:
    good = [(i, v) for i, v in rows if i is not None and v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    size = max({len(v) for _, v in good}, key=lambda n: (sum(len(v) == n for _, v in good), -n))
    good = [(i, np.array(v)) for i, v in good if len(v) == size and (zero or any(v))]
    out = {}
    for q, v in good:
        if q % 4 == 0:
            found = sorted((-float((v * w).sum()), i) for i, w in good if i != q)
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def got(df) -> dict[int, list[tuple[int, float]]]:
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def rows(seed: int, n: int = 300, size: int = 6):
    draw = np.random.default_rng(seed)
    found = [(i, [float(x) for x in draw.integers(-9, 10, size)]) for i in range(n)]
    found += [(n + i, found[7][1]) for i in range(60)]  # one vector very often
    found += [(1000, None), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1002, [float("nan")] * size), (1003, [float("inf")] * size)]
    return [*found, (1004, [1.0]), (1005, []), (None, found[0][1]), (1008, [0.0] * size), (1012, [0.0] * size)]


@pytest.mark.parametrize("k", [1, 20])
def test_top_k_is_exact(spark, k, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 64)
    data = rows(3)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    assert got(topk.top_k(df, even(), k)) == brute(data, k)


def test_lists_stop_early_and_miss_nothing():
    draw = np.random.default_rng(1)
    points = np.floor(64 * draw.standard_normal((2000, 3)))
    lists, ids = topk.Lists(points), np.arange(2000)
    for query in np.floor(64 * draw.standard_normal((20, 3))):
        found, scores = lists.search(query, ids, 5, -np.inf)
        expected = np.lexsort((ids, -(points @ query)))[:5]
        assert found.tolist() == expected.tolist() and scores.tolist() == (points @ query)[expected].tolist()
        beaten, _ = lists.search(query, ids, 5, scores[0] + 1)
        assert not len(beaten)


def test_few_candidates_and_empty_tables(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (4, [0.0, 1.0])], "vec_id long, embedding array<double>")
    for search in (topk.top_k, ann.nearest):
        assert got(search(few, even(), 20)) == {0: [(4, 0.0)], 4: [(0, 0.0)]}
        assert search(few.limit(0), even(), 20).count() == 0


def test_neighbours_when_every_list_is_probed(spark):
    data = rows(5)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert got(ann.nearest(df, even(), 20, probes=1.0)) == brute(data, 20, zero=False)


def test_neighbours_reach_the_recall(spark, sf_dir):
    from tidewise.llm.queries import QUERIES

    sf = sf_dir.replace("0.001", "0.01")
    data = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    matrix, ids = np.array([v for _, v in data]), np.array([i for i, _ in data])
    found = got(QUERIES["op4_ann"](spark, sf))
    hits = []
    for q, result in found.items():
        scores = (matrix * matrix[ids == q][0]).sum(axis=1)
        others = np.flatnonzero(ids != q)
        best = others[np.lexsort((ids[others], -scores[others]))[:20]]
        hits.append(len({i for i, _ in result} & set(ids[best].tolist())) / 20)
        assert all(s == pytest.approx(scores[ids == i][0], rel=1e-12) for i, s in result)
    assert len(found) == (ids % 20 == 0).sum() and np.mean(hits) >= 0.9


def test_a_huge_vector_leaves_the_others_found(spark):
    draw = np.random.default_rng(11)
    points = draw.standard_normal((1500, 16))
    points[700] *= 1e9
    points[701] *= 1e-9
    data = [(i, v.tolist()) for i, v in enumerate(points)]
    found, truth = got(ann.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>"), even(), 20)), brute(data, 20)
    share = [len({i for i, _ in found[q]} & {i for i, _ in best}) / 20 for q, best in truth.items()]
    assert np.mean(share) >= 0.9 and min(share) >= 0.5
    assert all((700 in [i for i, _ in found[q]]) == (700 in [i for i, _ in best]) for q, best in truth.items())


def test_scores_out_of_range_do_not_crash(spark):
    data = [(i, [1e200 * (i + 1), -1e200, 1e-200]) for i in range(8)] + [(8, [1e-310, 0.0, 0.0])]
    found = ann.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>"), even(), 3).collect()
    assert {r.query_id for r in found} == {0, 4, 8}


def test_every_cell_has_its_shards():
    counts = {1: 10, 2: vectors.SHARD_ROWS, 3: 5, 4: 3 * vectors.SHARD_ROWS + 1, 5: 7, 6: 9}
    assert ann.shards_of(counts) == {1: (0, 1), 2: (1, 1), 3: (2, 1), 4: (3, 4), 5: (7, 1), 6: (7, 1)}
