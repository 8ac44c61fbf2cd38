"""Pipeline inputs derived from the test tables (FIXTURES.md): raw logs, change records, dimensions, orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import DIM_LIST, FACT_LIST
from ..schemas import TABLE_LIST

# Parameters all registered queries share.
AS_OF = "2024-01-31"
TD = "2024-01-15"
ORDER_DAY = "2024-01-05"
MISSING_DAY = "2024-03-01"
LAST_DAY, PERIOD = "2024-01-31", 31  # the logs' days: January
ITEM = "red plate"
ITEM_ONE_TERM = "red"
EPOCH = 1704067200

# Change types by (key + version) % 6.
CHANGE_TYPES = ["bootstrap-insert", "insert", "update", "delete", "bootstrap-start", "ddl"]

# The two table lists.
FACT_TABLES = ["order_info", "order_detail", "sku_info"]
DIM_TABLES = ["user_info", "base_province", "sku_info"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame, pieces: int | None) -> DataFrame:
    """Deal rows to ``pieces`` tasks by their content: dealing them in turn sorts each task's rows first, to be repeatable."""
    return rows.repartition(pieces, *rows.columns) if pieces else rows


def _text(column: Column) -> Column:
    return column.cast("string")


def raw_log_records(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """(key, value, offset, timestamp): one application log per event, computed in ``pieces`` tasks."""
    read = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    e = _spread(read, pieces).withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    u, k, event = F.col("user_id"), F.col("k"), F.col("event_id")
    kind = F.col("event_type")
    moment = F.col("ts").cast("timestamp")
    ts = F.unix_millis(moment)
    mid = F.concat(F.lit("mid_"), _text(u))
    common = F.struct(
        _text(u % 25).alias("ar"),
        _text(u).alias("uid"),
        F.when(u % 2 == 0, "Android").otherwise("iOS").alias("os"),
        F.concat(F.lit("ch_"), _text(u % 5)).alias("ch"),
        F.when(event % 4 == 0, "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("md_"), _text(u % 7)).alias("md"),
        mid.alias("mid"),
        F.concat(F.lit("v2.1."), _text(u % 10)).alias("vc"),
        F.concat(F.lit("ba_"), _text(u % 3)).alias("ba"),
    )
    page_id = (
        F.when(kind == "view", "good_detail").when(kind == "click", "good_list").when(kind == "purchase", "payment")
    )
    last_page = F.when(event % 3 == 0, None).when((event % 3 == 1) & (event % 11 == 0), "").otherwise("home")
    page = F.when(
        kind.isin("view", "click", "purchase", "error"),
        F.struct(
            F.coalesce(page_id, F.lit("home")).alias("page_id"),
            _text(k).alias("item"),
            F.lit("sku_id").alias("item_type"),
            (k * 100).alias("during_time"),
            last_page.alias("last_page_id"),
            F.lit("query").alias("source_type"),
        ),
    )

    def items(n: Column, item) -> Column:
        return F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), n), item)).otherwise(F.array())

    displays = F.when(
        kind == "view",
        items(
            k % 4,
            lambda i: F.struct(
                F.lit("query").alias("display_type"),
                _text(k + i).alias("item"),
                F.lit("sku_id").alias("item_type"),
                _text(i).alias("pos_id"),
                i.alias("order"),
            ),
        ),
    )
    actions = F.when(
        kind == "click",
        items(
            k % 3,
            lambda i: F.struct(
                F.concat(F.lit("act_"), _text(i)).alias("action_id"),
                _text(k).alias("item"),
                F.lit("sku_id").alias("item_type"),
                (ts + i * 1000).alias("ts"),
            ),
        ),
    )
    start = F.when(
        kind == "signup",
        F.struct(
            F.lit("icon").alias("entry"),
            _text(k).alias("open_ad_id"),
            (k * 10).alias("loading_time"),
            (k * 7).alias("open_ad_ms"),
            k.alias("open_ad_skip_ms"),
        ),
    )
    err = F.when(kind == "error", F.struct(k.alias("error_code"), F.lit("m").alias("msg")))
    value = F.to_json(
        F.struct(
            common.alias("common"),
            page.alias("page"),
            displays.alias("displays"),
            actions.alias("actions"),
            start.alias("start"),
            err.alias("err"),
            ts.alias("ts"),
        )
    )
    return e.select(mid.alias("key"), value.alias("value"), event.alias("offset"), moment.alias("timestamp"))


def cdc_records(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """(key, value, offset): change records of five tables; every tenth user has three versions. Computed in ``pieces`` tasks."""
    once = F.lit(0).cast("bigint")

    def rows(label: str, source: str, key: str, version: Column = once, **data: str) -> DataFrame:
        known = [F.col(data[c]) if c in data else F.lit(None) for c in ("user_id", "total_amount", "name")]
        of = [c.cast(t).alias(n) for c, t, n in zip(known, ("bigint", "double", "string"), ("user_id", "total_amount", "name"))]
        return table(spark, sf_dir, source).select(F.lit(label).alias("table"), F.col(key).cast("bigint").alias("key"), version.alias("n"), *of)

    versions = F.when(F.col("c_custkey") % 10 == 0, F.sequence(once, F.lit(2).cast("bigint"))).otherwise(F.array(once))
    parts = [
        rows("order_info", "orders", "o_orderkey", user_id="o_custkey", total_amount="o_totalprice"),
        rows("user_info", "customer", "c_custkey", F.explode(versions)),
        rows("base_province", "nation", "n_nationkey", name="n_name"),
        rows("comment_info", "region", "r_regionkey", name="r_name"),
        rows("sku_info", "part", "p_partkey", name="p_name"),
    ]
    key, version, user = F.col("key"), F.col("n"), F.col("table") == "user_info"
    user_name = F.concat(F.lit("u"), _text(key), F.lit("_v"), _text(version))
    kind = F.element_at(F.array(*[F.lit(t) for t in CHANGE_TYPES]), ((key + version) % 6 + 1).cast("int"))
    # A field that a table does not have is NULL, which JSON leaves out.
    data = F.struct(
        key.alias("id"),
        "user_id",
        "total_amount",
        F.when(user, user_name).otherwise(F.col("name")).alias("name"),
        F.when(user, _gender(key)).alias("gender"),
        F.when(user, _birthday(key)).alias("birthday"),
    )
    value = F.to_json(
        F.struct(
            F.lit("shop").alias("database"),
            F.col("table"),
            kind.alias("type"),
            (F.lit(EPOCH).cast("bigint") + version).alias("ts"),
            data.alias("data"),
        )
    )
    dealt = _spread(reduce(DataFrame.unionByName, parts), pieces)
    return dealt.select(_text(key).alias("key"), value.alias("value"), (key * 3 + version).alias("offset"))


def table_lists(spark: SparkSession) -> DataFrame:
    rows = [(FACT_LIST, t) for t in FACT_TABLES] + [(DIM_LIST, t) for t in DIM_TABLES]
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, TABLE_LIST.names)]) for row in rows]
    return spark.sql("SELECT 1 AS one").select(F.inline(F.array(*structs)))


def _gender(key: Column) -> Column:
    return F.when(key % 10 == 9, None).when(key % 2 == 0, "F").otherwise("M")


def _birthday(key: Column) -> Column:
    return _text(F.date_add(F.lit("1960-01-01").cast("date"), ((key * 97) % 20000).cast("int")))


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key.alias("id"), _gender(key).alias("gender"), _birthday(key).alias("birthday"))


def base_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey").cast("bigint")
    return table(spark, sf_dir, "nation").select(
        key.alias("id"),
        F.col("n_name").alias("name"),
        _text(key + 100000).alias("area_code"),
        F.concat(F.lit("CN-"), _text(key)).alias("iso_code"),
        F.concat(F.lit("CN-P"), _text(key)).alias("iso_3166_2"),
    )


def _order_second(key: Column) -> Column:
    return F.lit(EPOCH).cast("bigint") + (key % 10) * 86400 + (key * 7919) % 86400


def _time_text(second: Column) -> Column:
    return F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd HH:mm:ss")


def order_info(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """Order headers, computed in ``pieces`` tasks: what is read is dealt out, not what is made of it."""
    key = F.col("o_orderkey")
    zero, no_text = F.lit(0.0), F.lit(None).cast("string")
    read = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return _spread(read, pieces).select(
        key.alias("id"),
        (key % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        zero.alias("activity_reduce_amount"),
        zero.alias("coupon_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"),
        F.lit(10.0).alias("feight_fee"),
        zero.alias("feight_fee_reduce"),
        no_text.alias("expire_time"),
        no_text.alias("refundable_time"),
        _time_text(_order_second(key)).alias("create_time"),
        no_text.alias("operate_time"),
    )


def order_detail(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """Order lines, computed in ``pieces`` tasks. The id is a digest of the line, so equal lines are one line sent twice."""
    read = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_shipdate".split()
    line, key = _spread(table(spark, sf_dir, "lineitem").select(*read), pieces), F.col("l_orderkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_name")

    def cents(name: str) -> Column:
        return F.round(F.col(name) * 100).cast("bigint")

    identity = F.concat_ws(
        "|",
        key,
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.unix_date(F.col("l_shipdate").cast("date")),
        cents("l_extendedprice"),
        cents("l_quantity"),
    )
    detail_id = F.conv(F.substring(F.md5(identity), 1, 15), 16, 10).cast("bigint")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        detail_id.alias("id"),
        key.alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("p_retailprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("p_name").alias("sku_name"),
        _time_text(_order_second(key) + F.col("l_linenumber") * 18000).alias("create_time"),
        F.col("l_extendedprice").alias("split_total_amount"),
        F.lit(0.0).alias("split_activity_amount"),
        F.lit(0.0).alias("split_coupon_amount"),
    )


def as_messages(rows: DataFrame, key: str) -> DataFrame:
    """Rows as keyed JSON messages with an offset and the row's own creation time."""
    return rows.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*rows.columns)).alias("value"),
        F.col("id").alias("offset"),
        F.to_timestamp("create_time", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
