"""Searches from term postings, and pages after a cursor, against searches over the documents."""

import os

import pytest
from pyspark.sql import functions as F
from test_skew import final_plan

from tidewise.functions.text import query_terms
from tidewise.operators import reports
from tidewise.plans.queries import QUERIES
from tidewise.sinks import postings

DAY = "2024-01-05"
NAMES = ["Red plate", "red RED cup", "blue plate", "plate, red (large)", "红色 plate", None, "", "red", "green Plate plate plate", "infrared plate"]


@pytest.fixture
def docs(spark):
    rows = [(i, NAMES[i % len(NAMES)], DAY if i % 4 else "2024-01-06") for i in range(80)]
    return spark.createDataFrame(rows, "detail_id LONG, sku_name STRING, dt STRING").repartition(3)


def searched(spark, path, item, day=DAY):
    terms = query_terms(spark, item)
    found = reports.postings_scored(postings.of_terms(spark, path, day, terms), postings.stats(spark, path, day), terms)
    return {r.detail_id: r.score for r in found.collect()}


@pytest.mark.parametrize("item", ["red plate", "RED", "plate red red", "nosuch", "red nosuch", "", "!?", "红色"])
def test_same_hits_and_scores_as_over_the_documents(spark, docs, tmp_path, item):
    path = str(tmp_path)
    postings.add_days(docs, path)
    expected = {r.detail_id: r.score for r in reports.item_scored(docs, item, DAY).collect()}
    assert searched(spark, path, item) == expected
    assert searched(spark, path, item, "2024-03-01") == {}


def test_a_day_is_replaced_as_a_whole(spark, docs, tmp_path):
    path = str(tmp_path)
    postings.add_days(docs, path)
    before = postings.of_terms(spark, path, DAY, ["red"])
    count = before.count()
    renamed = docs.where("dt = '2024-01-05'").withColumn("sku_name", F.when(F.col("detail_id") == 1, "red").otherwise("other"))
    for _ in range(2):
        postings.add_days(renamed, path)
        assert list(searched(spark, path, "red")) == [1] and searched(spark, path, "plate") == {}
    assert len(searched(spark, path, "plate", "2024-01-06")) > 0
    postings.add_days(docs, path)
    assert len(os.listdir(f"{path}/postings/dt={DAY}")) == 2 and len(searched(spark, path, "red")) > 1
    assert count == postings.of_terms(spark, path, DAY, ["red"]).count()


def test_only_the_terms_folders_are_read(spark, docs, tmp_path):
    path = str(tmp_path)
    postings.add_days(docs, path)
    some = postings.of_terms(spark, path, DAY, ["red", "plate"])
    assert len({f.rsplit("/", 1)[0] for f in some.inputFiles()}) <= 2
    plan = final_plan(some)
    assert "PushedFilters: [In(term" in plan and "split(" not in plan


def test_query_splits_no_name(spark, sf_dir):
    frame = QUERIES["item_search_postings"](spark, sf_dir)
    plan = final_plan(frame)
    assert "sku_name" not in plan and "split(" not in plan
    assert all("/postings-" in f for f in frame.inputFiles())


def test_pages_after_a_cursor_are_the_numbered_pages(spark, sf_dir):
    from tidewise.plans import landing

    docs = landing.order_docs(spark, sf_dir, [DAY], *reports.DETAIL_COLUMNS)
    after, seen = None, []
    for number in range(1, 6):
        page = reports.detail_after(docs, "plate", DAY, after, page_size=7).collect()
        expected = reports.detail_by_item(docs, "plate", DAY, number, 7).collect()
        assert [tuple(r)[:-2] for r in page] == [tuple(r) for r in expected]
        if not page:
            break
        after = (page[-1].score, page[-1].detail_id)
        seen += [r.detail_id for r in page]
    assert len(seen) == len(set(seen)) > 7
    assert reports.detail_after(docs, "nosuch", DAY).isEmpty() and reports.detail_after(docs, "plate", "2024-03-01").isEmpty()
    with pytest.raises(ValueError):
        reports.detail_after(docs, "plate", DAY, page_size=-1)


def test_terms_are_counted_without_a_shuffle(spark):
    rows = [(1, "d1", ["red", "plate", "red"], 3), (2, "d1", [], 0), (None, "d2", ["red"], 1)]
    named = spark.createDataFrame(rows, "detail_id LONG, dt STRING, terms ARRAY<STRING>, length LONG")
    found = postings.counted(named)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {("d1", "red", 1, 2, 3), ("d1", "plate", 1, 1, 3), ("d2", "red", None, 1, 1)}
