"""Budgets of the mixture by hand and against a plain version, and the selection against SQL."""

import random
from collections import defaultdict

import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F

from tidewise.llm import mixing
from tidewise.llm.queries import ORACLE, QUERIES

LEAF = "domain string, lang string, source string, tokens long"


def budget_of(spark, leaves, total, weights=None, epochs=1):
    out = mixing.budgets(spark.createDataFrame(leaves, LEAF), total, epochs, weights or {})
    return {(r.domain, r.lang, r.source): r.budget for r in out.collect()}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = [("d", "x", "s1", 10), ("d", "x", "s2", 1000), ("d", "y", "s3", 1000), ("e", "x", "s1", 1000)]
    # e and d get 300 each; x and y 150 each; s1 can only give 10, so its sibling s2 gives 140 and y stays at 150.
    assert budget_of(spark, leaves, 600) == {
        ("d", "x", "s1"): 10, ("d", "x", "s2"): 140, ("d", "y", "s3"): 150, ("e", "x", "s1"): 300
    }
    # What x as a whole cannot give goes to y, and what d cannot give to e.
    short = [("d", "x", "s1", 10), ("d", "x", "s2", 20), ("d", "y", "s3", 100), ("e", "x", "s1", 1000)]
    assert budget_of(spark, short, 600) == {
        ("d", "x", "s1"): 10, ("d", "x", "s2"): 20, ("d", "y", "s3"): 100, ("e", "x", "s1"): 470
    }


def test_weights_epochs_and_rounding(spark):
    leaves = [("d", "x", f"s{i}", 100) for i in range(3)]
    assert sorted(budget_of(spark, leaves, 100).values()) == [33, 33, 34]
    assert budget_of(spark, leaves, 100, {"source": {"s0": 2.0}})[("d", "x", "s0")] == 50
    assert sum(budget_of(spark, leaves, 10_000, epochs=2).values()) == 600
    assert budget_of(spark, leaves, 90, {"source": {"s0": 0.0}}) == {("d", "x", "s0"): 0, ("d", "x", "s1"): 45, ("d", "x", "s2"): 45}
    assert budget_of(spark, [(None, None, None, 5), ("d", None, "s", 5)], 4) == {(None, None, None): 2, ("d", None, "s"): 2}


def plain(leaves, total, epochs):
    """Water filling over the tree, in fractions."""
    room = {k: t * epochs for k, t in leaves.items()}

    def fill(budget, rooms):
        share, open_ = {}, dict(rooms)
        while open_:
            each = budget / len(open_)
            full = {k: r for k, r in open_.items() if r <= each}
            if not full:
                share.update(dict.fromkeys(open_, each))
                break
            for k, r in full.items():
                share[k] = r
                budget -= r
                del open_[k]
        return share

    given = {(): min(total, sum(room.values()))}
    for depth in range(3):
        below = defaultdict(lambda: defaultdict(int))
        for k, r in room.items():
            below[k[:depth]][k[: depth + 1]] += r
        given = {k: v for parent, rooms in below.items() for k, v in fill(given[parent], rooms).items()}
    return given


def test_budgets_against_plain_filling(spark):
    random.seed(3)
    for _ in range(3):
        leaves = {(f"d{random.randint(0, 2)}", f"l{random.randint(0, 2)}", f"s{i}"): random.randint(1, 500) for i in range(12)}
        got = budget_of(spark, [(*k, t) for k, t in leaves.items()], 1500, epochs=2)
        expected = plain(leaves, 1500, 2)
        assert sum(got.values()) == min(1500, 2 * sum(leaves.values()))
        assert all(abs(got[k] - expected[k]) <= 4 for k in got)


@pytest.mark.parametrize("name", ["op1_topk", "op2_mixing", "op7_urls"])
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) == []


def test_prefix_adds_up_and_odd_rows(spark):
    rows = [(i, "w " * (1 + i % 7), "x" if i % 3 else None, f"s{i % 2}", "old") for i in range(200)]
    rows += [(200, None, "x", "s0", "old"), (201, "", "x", "s0", "old"), (None, "a b", "x", "s0", "old"), (5, "w " * 6, "x", "s1", "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epoch string")
    out = mixing.mix(df, F.lit("one"), 900, epochs=3)
    assert out.columns == ["doc_id", "text", "lang", "source", "domain", "epoch", "take_tokens"]
    got = out.collect()
    assert {r.doc_id for r in got}.isdisjoint({200, 201, None})
    # The repeated row of 5 is one unit: it stands twice for one amount.
    once = {(r.doc_id, r.lang, r.source, r.epoch): r.take_tokens for r in got}
    assert sum(once.values()) == 900
    assert mixing.mix(df, F.lit("one"), 900, epochs=3).exceptAll(out).count() == 0
    assert mixing.mix(df.limit(0), F.lit("one"), 0.5).count() == 0
