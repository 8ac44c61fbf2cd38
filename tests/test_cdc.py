import json

import pytest

from tidewise.operators import cdc
from tidewise.schemas import TABLE_LIST, USER_DIM

LISTS = [("FACT:TABLES", "order_info"), ("FACT:TABLES", "sku_info"), ("DIM:TABLES", "user_info"), ("DIM:TABLES", "sku_info")]


def change(kind, table="user_info", ts=1, **data):
    return {"database": "d", "table": table, "type": kind, "ts": ts, "data": data}


@pytest.fixture
def lists(spark):
    return spark.createDataFrame(LISTS, TABLE_LIST)


def changes(spark, *records):
    return cdc.changes(cdc.parse_cdc(spark.createDataFrame([(json.dumps(r),) for r in records], "value STRING")))


def test_op_codes(spark):
    kinds = ["bootstrap-insert", "insert", "update", "delete", "bootstrap-start", "ddl", "INSERT", None]
    rows = changes(spark, *[change(k, id=i) for i, k in enumerate(kinds)]).collect()
    assert {r.type: r.op for r in rows} == {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D"}


def test_fact_route_names_topic_by_table_and_op(spark, lists):
    rows = cdc.fact_messages(
        changes(spark, change("insert", "order_info", id=1), change("delete", "order_info", id=2), change("insert", "other", id=3)), lists
    ).collect()
    assert {(r.topic, r.key) for r in rows} == {("DWD_ORDER_INFO_I_0522", "1"), ("DWD_ORDER_INFO_D_0522", "2")}
    assert json.loads(rows[0].value) == {"id": int(rows[0].key)}


def test_table_in_both_lists_goes_both_ways(spark, lists):
    c = changes(spark, change("update", "sku_info", id=5))
    assert cdc.fact_messages(c, lists).count() == 1 and cdc.dim_rows(c, lists).count() == 1


def test_latest_image_wins_and_delete_keeps_it(spark, lists):
    rows = cdc.dim_rows(
        changes(
            spark,
            change("insert", ts=1, id=1, gender="M"),
            change("update", ts=3, id=1, gender="F"),
            change("update", ts=2, id=1, gender="X"),
            change("insert", ts=1, id=2, gender="M"),
            change("delete", ts=2, id=2, gender="M"),
        ),
        lists,
    )
    kept = {r.id: r.gender for r in cdc.typed_dim(cdc.latest_dim(rows), "user_info", USER_DIM).collect()}
    assert kept == {1: "F", 2: "M"}
    dropped = cdc.typed_dim(cdc.latest_dim(rows, drop_deleted=True), "user_info", USER_DIM)
    assert [r.id for r in dropped.collect()] == [1]


def test_broken_records_are_dropped(spark):
    assert cdc.changes(cdc.parse_cdc(spark.createDataFrame([("x",), ("",)], "value STRING"))).isEmpty()
