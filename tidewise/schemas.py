"""Record schemas of the pipeline.

Numbers inside incoming JSON are declared as STRING and cast afterwards
(``json_form``): a producer may quote them, and ``from_json`` would turn a
quoted number into NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

STR, LONG, INT, DBL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _struct(dtype: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(n, dtype) for n in names.split()]


# Topic names of the pipeline.
RAW_LOG_TOPIC = "ODS_BASE_LOG_0522"
RAW_CDC_TOPIC = "ODS_BASE_DB_0522"
PAGE_TOPIC = "DWD_PAGE_LOG_TOPIC_0522"
DISPLAY_TOPIC = "DWD_PAGE_DISPLAY_TOPIC_0522"
ACTION_TOPIC = "DWD_PAGE_ACTION_TOPIC_0522"
START_TOPIC = "DWD_START_LOG_TOPIC_0522"
ERROR_TOPIC = "DWD_ERROR_LOG_TOPIC_0522"
CORRUPT_TOPIC = "DWD_CORRUPT_LOG_TOPIC_0522"
ORDER_INFO_TOPIC = "DWD_ORDER_INFO_I_0522"
ORDER_DETAIL_TOPIC = "DWD_ORDER_DETAIL_I_0522"
TABLE_TOPIC_PREFIX = "DWD_"
TABLE_TOPIC_SUFFIX = "_0522"

# Shape of a record read from a topic.
TOPIC_RECORD = T.StructType(
    _struct(STR, "key value topic")
    + _struct(INT, "partition")
    + _struct(LONG, "offset")
    + _struct(T.TimestampType(), "timestamp")
)

# Raw application log. `err` stays text: an error record is forwarded untouched.
RAW_LOG = T.StructType(
    [
        T.StructField("common", T.StructType(_struct(STR, "ar uid os ch is_new md mid vc ba"))),
        T.StructField(
            "page", T.StructType(_struct(STR, "page_id item item_type during_time last_page_id source_type"))
        ),
        T.StructField(
            "displays", T.ArrayType(T.StructType(_struct(STR, "display_type item item_type pos_id order")))
        ),
        T.StructField("actions", T.ArrayType(T.StructType(_struct(STR, "action_id item item_type ts")))),
        T.StructField(
            "start", T.StructType(_struct(STR, "entry open_ad_id loading_time open_ad_ms open_ad_skip_ms"))
        ),
        T.StructField("err", STR),
        T.StructField("ts", STR),
    ]
)

# Change record. `data` stays text: each table has its own columns.
CDC = T.StructType(_struct(STR, "database table type ts data"))

# JSON name -> column name of the fields every log record shares, in column order.
COMMON_FIELDS = {
    "mid": "mid",
    "uid": "user_id",
    "ar": "province_id",
    "ch": "channel",
    "is_new": "is_new",
    "md": "model",
    "os": "operate_system",
    "vc": "version_code",
    "ba": "brand",
}
PAGE_FIELDS = {
    "page_id": "page_id",
    "last_page_id": "last_page_id",
    "item": "page_item",
    "item_type": "page_item_type",
    "source_type": "sourceType",
}
DISPLAY_FIELDS = {
    "display_type": "display_type",
    "item": "display_item",
    "item_type": "display_item_type",
    "order": "display_order",
    "pos_id": "display_pos_id",
}
ACTION_FIELDS = {"action_id": "actionId", "item": "actionItem", "item_type": "actionItemType"}

_PAGE_TEXT = " ".join([*COMMON_FIELDS.values(), *PAGE_FIELDS.values()])

PAGE_LOG = T.StructType(_struct(STR, _PAGE_TEXT) + _struct(LONG, "during_time ts"))
# Stored forms: page records by day, numbers of devices, and a day's devices as bits.
PAGE_DAY = T.StructType(PAGE_LOG.fields + _struct(STR, "hr dt"))
HOURLY_ACTIVES = T.StructType(_struct(STR, "hr") + _struct(LONG, "n") + _struct(STR, "dt"))
DEVICES = T.StructType(_struct(STR, "mid") + _struct(LONG, "number"))
DEVICE_BITS = T.StructType(_struct(STR, "kind") + _struct(LONG, "bucket") + _struct(T.BinaryType(), "bitmap"))
PAGE_DISPLAY_LOG = T.StructType(
    _struct(STR, _PAGE_TEXT)
    + _struct(LONG, "during_time")
    + _struct(STR, " ".join(DISPLAY_FIELDS.values()))
    + _struct(LONG, "ts")
)
PAGE_ACTION_LOG = T.StructType(
    _struct(STR, _PAGE_TEXT)
    + _struct(LONG, "during_time")
    + _struct(STR, " ".join(ACTION_FIELDS.values()))
    + _struct(LONG, "actionTs ts")
)
START_LOG = T.StructType(
    _struct(STR, " ".join(n for n in COMMON_FIELDS.values() if n != "brand"))
    + _struct(STR, "entry open_ad_id")
    + _struct(LONG, "loading_time open_ad_ms open_ad_skip_ms ts")
)

# Daily-active document. `user_age` is text here and a number in orders.
DAU_INFO = T.StructType(
    [f for f in PAGE_LOG if f.name not in ("last_page_id", "ts")]
    + _struct(STR, "user_gender user_age province_name province_iso_code province_3166_2 province_area_code dt hr")
    + _struct(LONG, "ts")
)

ORDER_INFO = T.StructType(
    _struct(LONG, "id province_id")
    + _struct(STR, "order_status")
    + _struct(LONG, "user_id")
    + _struct(
        DBL,
        "total_amount activity_reduce_amount coupon_reduce_amount original_total_amount feight_fee feight_fee_reduce",
    )
    + _struct(STR, "expire_time refundable_time create_time operate_time")
)
ORDER_DETAIL = T.StructType(
    _struct(LONG, "id order_id sku_id")
    + _struct(DBL, "order_price")
    + _struct(LONG, "sku_num")
    + _struct(STR, "sku_name create_time")
    + _struct(DBL, "split_total_amount split_activity_amount split_coupon_amount")
)
ORDER_INFO_DERIVED = T.StructType(
    _struct(
        STR,
        "create_date create_hour province_name province_area_code province_3166_2_code province_iso_code",
    )
    + _struct(INT, "user_age")
    + _struct(STR, "user_gender")
)
ORDER_INFO_WIDE = T.StructType(ORDER_INFO.fields + ORDER_INFO_DERIVED.fields)
ORDER_WIDE = T.StructType(
    _struct(LONG, "detail_id order_id sku_id")
    + _struct(DBL, "order_price")
    + _struct(LONG, "sku_num")
    + _struct(STR, "sku_name")
    + _struct(DBL, "split_total_amount split_activity_amount split_coupon_amount")
    + [f for f in ORDER_INFO if f.name != "id"]
    + ORDER_INFO_DERIVED.fields
)

POSTING = T.StructType(_struct(STR, "term") + _struct(LONG, "detail_id tf length"))
POSTING_STATS = T.StructType(_struct(LONG, "docs terms") + _struct(STR, "run"))

# Stored forms carry the partition column.
ORDER_WIDE_STORED = T.StructType(ORDER_WIDE.fields + _struct(STR, "dt"))

USER_DIM = T.StructType(_struct(LONG, "id") + _struct(STR, "gender birthday"))
PROVINCE_DIM = T.StructType(_struct(LONG, "id") + _struct(STR, "name area_code iso_code iso_3166_2"))
DIM_ROW = T.StructType(_struct(STR, "table_name id op data") + _struct(LONG, "ts"))

TABLE_LIST = T.StructType(_struct(STR, "list_name table_name"))
NAME_VALUE = T.StructType(_struct(STR, "name") + _struct(DBL, "value"))


def json_form(schema: T.StructType) -> T.StructType:
    """The same fields, all read as text."""
    return T.StructType([T.StructField(f.name, STR) for f in schema])
