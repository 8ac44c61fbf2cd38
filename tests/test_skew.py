"""Plans that must hold when one key carries a third of all rows."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tidewise.functions.rows import pick_one
from tidewise.operators import dau, dims, orders
from tidewise.plans import landing
from tidewise.schemas import ORDER_DETAIL, ORDER_INFO_WIDE
from tidewise.sources import samples
from tidewise.streaming.state import thin

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def keep(df, path):
    """A stored copy: its plan holds no constants to fold and no shuffle of its own."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def conform(df, schema):
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


@pytest.fixture
def hot_orders(spark, tmp_path):
    """Order 0 holds a third of the lines and a third of the headers are copies of its header."""
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    time = F.concat(F.lit("2024-01-02 12:00:0"), (key % 10).cast("string"))
    infos = spark.range(0, n, 1, 8).select(key.alias("id"), time.alias("create_time"), F.lit("2024-01-02").alias("create_date"))
    details = spark.range(0, n, 1, 8).select(
        "id", key.alias("order_id"), F.lit("2024-01-02 13:00:00").alias("create_time"), F.sha2(F.col("id").cast("string"), 256).alias("sku_name")
    )
    infos = keep(conform(infos, ORDER_INFO_WIDE), f"{tmp_path}/i")
    return infos, keep(conform(details, ORDER_DETAIL), f"{tmp_path}/d"), n


def test_hot_order_is_split_in_the_join(spark, hot_orders):
    infos, details, n = hot_orders
    with settings(spark, SMALL):
        pairs = orders.order_pairs(infos, details).select("d.id", "d.sku_name")
        assert "SortMergeJoin(skew=true)" in final_plan(pairs)
        assert pairs.count() == n
        wide = orders.order_wide(infos, details)
        assert "SortMergeJoin(skew=true)" in final_plan(wide)
        assert wide.count() == n


def test_hot_order_is_split_in_the_outer_join(spark, hot_orders):
    infos, details, n = hot_orders
    with settings(spark, SMALL):
        outer = orders.order_full_outer(infos, details)
        assert "SortMergeJoin(skew=true)" in final_plan(outer)
        assert outer.count() == n


def test_hot_user_is_split_in_the_lookup(spark):
    n = 60_000
    facts = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    users = spark.range(0, n, 1, 8).select("id", F.lit("F").alias("gender"), F.lit("2000-01-01").alias("birthday"))
    with settings(spark, SMALL):
        enriched = dims.enrich_user(facts, users, "2024-01-31")
        assert "SortMergeJoin(skew=true)" in final_plan(enriched)
        assert enriched.count() == n


def test_small_dimension_is_broadcast_and_large_is_not(spark):
    facts = spark.range(1000).select(F.col("id").alias("user_id"))
    users = spark.range(1000).select("id", F.lit("F").alias("gender"), F.lit("2000-01-01").alias("birthday"))
    assert "BroadcastHashJoin" in final_plan(dims.enrich_user(facts, users))
    with settings(spark, SMALL):
        assert "BroadcastHashJoin" not in final_plan(dims.enrich_user(facts, users))


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(0, 90_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    one = pick_one(rows, ["k"], ["v"])
    plan = final_plan(one)
    below = plan[plan.index("Exchange hashpartitioning(k") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert one.count() == 60_001 and one.where("k = 0").first().v == 0
    latest = pick_one(rows, ["k"], ["v"], latest=True)
    assert latest.where("k = 0").first().v == 89_997


def test_first_hours_matches_first_seen(spark):
    entries = spark.range(3000).select(
        F.concat(F.lit("m"), (F.col("id") % 7).cast("string")).alias("mid"),
        (F.lit(1_704_067_200_000) + (F.col("id") * 7_919_000) % 200_000_000).alias("ts"),
        F.lit("p").alias("page_id"),
    )
    dated = dau.with_day(entries)
    first = {(r.mid, r.dt, r.hr) for r in dau.first_seen(dated).collect()}
    assert {tuple(r) for r in dau.first_hours(dated).collect()} == first


def test_thin_keeps_every_key_and_drops_repeats(spark):
    rows = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 500).alias("k"),
        F.to_timestamp(F.lit("2024-01-01 05:00:00")).alias("t"),
        F.struct(F.col("id").alias("x")).alias("s"),
    )
    thinned = thin(rows, ["k", "t"])
    assert thinned.schema == rows.schema
    assert {r.k for r in thinned.select("k").distinct().collect()} == {r.k for r in rows.select("k").distinct().collect()}
    assert thinned.count() <= 4 * 501
    first = thinned.where("k = 1").agg(F.min("s.x")).first()[0]
    assert first == 1 and thinned.select("t").distinct().count() == 1


def test_documents_are_compared_only_where_a_line_or_header_comes_again(spark, tmp_path):
    """The same documents as ``order_wide``, with lines sent again for other orders, headers sent again, and ids that are NULL."""
    hour = F.concat(F.lit("2024-01-02 1"), (F.col("id") % 10).cast("string"), F.lit(":00:00"))
    order = F.when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 400)
    line = F.when(F.col("id") % 101 == 0, None).when(F.col("id") >= 1900, F.col("id") - 1900).otherwise(F.col("id"))
    infos = spark.range(450).select((F.col("id") % 430).alias("id"), hour.alias("create_time"), F.col("id").cast("string").alias("create_date"))
    details = spark.range(2000).select(line.alias("id"), order.alias("order_id"), hour.alias("create_time"), F.col("id").cast("string").alias("sku_name"))
    infos, details = keep(conform(infos, ORDER_INFO_WIDE), f"{tmp_path}/i"), keep(conform(details, ORDER_DETAIL), f"{tmp_path}/d")
    headers, lines = keep(orders.repeated(infos), f"{tmp_path}/h"), keep(orders.repeated(details), f"{tmp_path}/l")
    compared = keep(orders.to_compare(details, headers, lines), f"{tmp_path}/c")
    assert 0 < compared.count() < details.count()
    assert compared.count() + orders.to_compare(details, headers, lines, those=False).count() == details.count()
    apart = orders.order_wide_apart(infos, details, headers, lines, compared, compared.select(F.col("order_id").alias("id")).distinct())
    whole = orders.order_wide(infos, details)
    assert apart.columns == whole.columns and apart.count() == whole.count()
    assert apart.exceptAll(whole).count() == 0


def test_a_user_of_two_rows_makes_no_second_document(spark, tmp_path):
    rows = {
        "customer": ("c_custkey LONG", [(1,), (1,), (2,)]),
        "nation": ("n_nationkey INT, n_name STRING", [(n, "N") for n in range(25)]),
        "orders": ("o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE", [(1, 1, "O", 2.0), (2, 2, "O", 3.0)]),
        "part": ("p_partkey LONG, p_retailprice DOUBLE, p_name STRING", [(1, 1.0, "red plate")]),
        "lineitem": (
            "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ",
            [(o, 1, 1, n, 1.0, 1.0, None) for o in (1, 2) for n in (1, 2)],
        ),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = landing.order_wide(spark, str(tmp_path)).select("detail_id", "order_id").collect()
    assert len(docs) == 4 and len({d.detail_id for d in docs}) == 4


def test_landed_orders_are_dealt_without_a_sort(spark, sf_dir):
    for rows in (samples.order_info(spark, sf_dir, 8), samples.order_detail(spark, sf_dir, 8)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and "RoundRobin" not in plan
