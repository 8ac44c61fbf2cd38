import pytest
from pyspark.sql import functions as F

from tidewise.operators import dashboard as d


@pytest.fixture
def pages(spark):
    rows = [
        ("a", "1", "0", "c1", None, "home", 1000, "2024-01-15"),
        ("a", "1", "0", "c1", "home", "good_detail", 3000, "2024-01-15"),
        ("b", "2", "1", "c2", None, "home", 2000, "2024-01-15"),
        ("b", "2", "1", "c2", "", "payment", 2000, "2024-01-09"),
        ("b", "2", "1", "c2", None, "home", 2000, "2024-01-08"),
    ]
    names = "mid user_id is_new channel last_page_id page_id during_time dt".split()
    given = spark.createDataFrame(rows, ", ".join(f"{n} {'LONG' if n == 'during_time' else 'STRING'}" for n in names))
    moment = F.unix_millis(F.col("dt").cast("timestamp")) + F.when(F.col("last_page_id") == "home", 9).otherwise(0)
    return given.withColumn("ts", moment).withColumn("page_item", F.lit("1"))


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_period_and_its_default(pages):
    assert rows(d.pv_count(pages, "2024-01-15")) == {("2024-01-15", 3), ("2024-01-09", 1)}
    assert rows(d.pv_count(pages, "2024-01-15", 0)) == rows(d.pv_count(pages, "2024-01-15"))
    assert rows(d.uv_count(pages, "2024-01-15", 1)) == {("2024-01-15", 2)}
    assert rows(d.visit_total(pages, "2024-01-15")) == {(4, 2, 1)}
    assert rows(d.visit_total(pages, "2025-01-15")) == {(0, 0, 0)}


def test_visits(pages):
    stats = {r.metric: (r.old, r.new) for r in d.new_visit_stats(pages, "2024-01-15").collect()}
    assert stats == {"浏览量": (2, 2), "访客数": (1, 1), "跳出率": (0, 1), "平均访问时长": (4, 2), "平均访问页面数": (2, 1)}
    assert rows(d.channel(pages, "2024-01-15", "br")) == {("c1", 0.0), ("c2", 1.0)}
    again = pages.where("last_page_id = 'home'").withColumn("last_page_id", F.lit(None).cast("string")).withColumn("ts", F.col("ts") + 50)
    twice = {r.metric: r.old for r in d.new_visit_stats(pages.unionByName(again), "2024-01-15").collect()}
    assert twice == {"浏览量": 3, "访客数": 1, "跳出率": 0.5, "平均访问时长": 3.5, "平均访问页面数": 1.5}
    with pytest.raises(ValueError):
        d.channel(pages, "2024-01-15", "xx")


def test_paths_and_funnel(pages):
    assert rows(d.page_path(pages, "2024-01-15")) == {("home", "good_detail", 1)}
    funnel = [tuple(r) for r in d.user_action_convert(pages, "2024-01-15").collect()]
    assert funnel == [("首页", 2), ("商品详情", 1), ("加购物车", 0), ("订单", 0), ("支付", 1)]


def test_orders(spark, pages):
    wide = spark.createDataFrame(
        [(1, 10, 7, "P", 5.0, 2.0, "x", "2024-01-15"), (2, 10, 7, "P", 5.0, 3.0, "y", "2024-01-15"), (3, 11, 7, "Q", 4.0, 4.0, "y", "2024-01-14")],
        "detail_id LONG, order_id LONG, user_id LONG, province_name STRING, total_amount DOUBLE, split_total_amount DOUBLE, sku_name STRING, dt STRING",
    )
    users = spark.createDataFrame([(7,), (8,)], "id LONG")
    assert rows(d.order_total(wide, "2024-01-15")) == {(2, 9.0, 1)}
    assert rows(d.area(wide, "2024-01-15")) == {("P", 1), ("Q", 1)}
    assert rows(d.user_paid(users, wide, "2024-01-15")) == {("paid", 1), ("unpaid", 1)}
    assert rows(d.user_total(users, pages, wide, "2024-01-15")) == {(2, 1, 9.0)}
    assert [tuple(r) for r in d.top_sales(wide, "2024-01-15", "sku_name", 1).collect()] == [("y", 7.0)]
    assert rows(d.order_total(wide, "2025-01-15")) == {(0, 0.0, 0)}
