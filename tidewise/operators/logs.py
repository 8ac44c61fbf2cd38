"""Raw application logs: parse once, then split into typed record streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import typed
from ..schemas import (
    ACTION_FIELDS,
    ACTION_TOPIC,
    COMMON_FIELDS,
    CORRUPT_TOPIC,
    DISPLAY_FIELDS,
    DISPLAY_TOPIC,
    ERROR_TOPIC,
    PAGE_FIELDS,
    PAGE_LOG,
    PAGE_TOPIC,
    RAW_LOG,
    START_TOPIC,
    json_form,
)

_CORRUPT = "_corrupt"
_MESSAGES = "array<struct<topic:string,key:string,value:string>>"


def parse_json(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the fields of the JSON in ``value``, and ``_corrupt`` (the text, where it is not such an object).

    ``inline`` over a one-element array, unlike a struct column, keeps later
    filters from being pushed below it as a second and third ``from_json``.
    """
    fields = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    document = F.from_json("value", fields, {"columnNameOfCorruptRecord": _CORRUPT})
    blank = F.col("value").isNull() | (F.trim("value") == "")
    return raw.select("*", F.inline(F.array(document))).withColumn(
        _CORRUPT, F.when(blank, F.coalesce("value", F.lit(""))).otherwise(F.col(_CORRUPT))
    )


def parse_logs(raw: DataFrame) -> DataFrame:
    return parse_json(raw, RAW_LOG).withColumn("ts", F.col("ts").try_cast("bigint"))


def _is_error() -> Column:
    return F.col(_CORRUPT).isNull() & F.col("err").isNotNull()


def _is_clean() -> Column:
    return F.col(_CORRUPT).isNull() & F.col("err").isNull()


def _common(skip: tuple[str, ...] = ()) -> list[Column]:
    return [F.col(f"common.{src}").alias(name) for src, name in COMMON_FIELDS.items() if name not in skip]


def _page() -> list[Column]:
    return [
        *_common(),
        *[F.col(f"page.{src}").alias(name) for src, name in PAGE_FIELDS.items()],
        F.col("page.during_time").try_cast("bigint").alias("during_time"),
    ]


def _display(item: Column) -> list[Column]:
    return [item[src].alias(name) for src, name in DISPLAY_FIELDS.items()]


def _action(item: Column) -> list[Column]:
    return [
        *[item[src].alias(name) for src, name in ACTION_FIELDS.items()],
        item["ts"].try_cast("bigint").alias("actionTs"),
    ]


def _start() -> list[Column]:
    return [
        *_common(skip=("brand",)),
        *[F.col(f"start.{n}").alias(n) for n in ("entry", "open_ad_id")],
        *[F.col(f"start.{n}").try_cast("bigint").alias(n) for n in ("loading_time", "open_ad_ms", "open_ad_skip_ms")],
    ]


def page_log(parsed: DataFrame) -> DataFrame:
    return parsed.where(_is_clean() & F.col("page").isNotNull()).select(*_page(), "ts")


def page_display_log(parsed: DataFrame) -> DataFrame:
    """One row per displayed item; records without any give none."""
    shown = parsed.where(_is_clean() & F.col("page").isNotNull()).withColumn("d", F.explode("displays"))
    return shown.select(*_page(), *_display(F.col("d")), "ts")


def page_action_log(parsed: DataFrame) -> DataFrame:
    done = parsed.where(_is_clean() & F.col("page").isNotNull()).withColumn("a", F.explode("actions"))
    return done.select(*_page(), *_action(F.col("a")), "ts")


def start_log(parsed: DataFrame) -> DataFrame:
    return parsed.where(_is_clean() & F.col("start").isNotNull()).select(*_start(), "ts")


def error_log(parsed: DataFrame) -> DataFrame:
    """The untouched text of records that carry an error, whatever else they hold."""
    return parsed.where(_is_error()).select("value")


def corrupt_log(parsed: DataFrame) -> DataFrame:
    """The untouched text of records that are no JSON object of the expected shape."""
    return parsed.where(F.col(_CORRUPT).isNotNull()).select("value")


def fan_out(parsed: DataFrame) -> DataFrame:
    """All outgoing messages as (topic, key, value), keyed by device.

    Each record is read and parsed once and exploded into its messages; a union
    of five filtered projections would scan and parse the source five times.
    """
    key = F.col("common.mid")
    none = F.array().cast(_MESSAGES)

    def message(topic: str, value: Column) -> Column:
        return F.struct(F.lit(topic).alias("topic"), key.alias("key"), value.alias("value"))

    def record(*fields: Column) -> Column:
        return F.to_json(F.struct(*fields))

    ts = F.col("ts")
    on_page = F.col("page").isNotNull()
    pages = F.when(on_page, F.array(message(PAGE_TOPIC, record(*_page(), ts))))
    displays = F.when(
        on_page, F.transform("displays", lambda d: message(DISPLAY_TOPIC, record(*_page(), *_display(d), ts)))
    )
    actions = F.when(
        on_page, F.transform("actions", lambda a: message(ACTION_TOPIC, record(*_page(), *_action(a), ts)))
    )
    starts = F.when(F.col("start").isNotNull(), F.array(message(START_TOPIC, record(*_start(), ts))))
    parts = F.concat(*[F.coalesce(part, none) for part in (pages, displays, actions, starts)])
    messages = (
        F.when(F.col(_CORRUPT).isNotNull(), F.array(message(CORRUPT_TOPIC, F.col("value"))))
        .when(F.col("err").isNotNull(), F.array(message(ERROR_TOPIC, F.col("value"))))
        .otherwise(parts)
    )
    return parsed.select(F.inline(messages))


def split_counts(parsed: DataFrame) -> DataFrame:
    """(branch, n) in one pass: records parsed, of those in error, clean, corrupt, and messages per branch."""

    def count(condition: Column) -> Column:
        return F.coalesce(F.count_if(condition), F.lit(0)).cast("bigint")

    def total(condition: Column, items: str) -> Column:
        size = F.when(condition & F.col(items).isNotNull(), F.size(items)).otherwise(0)
        return F.coalesce(F.sum(size), F.lit(0)).cast("bigint")

    on_page = _is_clean() & F.col("page").isNotNull()
    counts = {
        "parsed": F.count(F.lit(1)),
        "corrupt": count(F.col(_CORRUPT).isNotNull()),
        "error": count(_is_error()),
        "clean": count(_is_clean()),
        "no_common": count(_is_clean() & F.col("common").isNull()),
        "page": count(on_page),
        "display": total(on_page, "displays"),
        "action": total(on_page, "actions"),
        "start": count(_is_clean() & F.col("start").isNotNull()),
    }
    one = parsed.agg(*[c.alias(name) for name, c in counts.items()])
    return one.unpivot([], list(counts), "branch", "n")


def quality_counts() -> list[Column]:
    """Records parsed, and of those the unreadable ones and the ones without common fields."""
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(_CORRUPT).isNotNull()).alias("corrupt"),
        F.count_if(_is_clean() & F.col("common").isNull()).alias("no_common"),
    ]


def route_counts() -> list[Column]:
    """Records by what they are filed as first: each counts once."""
    corrupt, error = F.col(_CORRUPT).isNotNull(), _is_error()
    page = _is_clean() & F.col("page").isNotNull()
    start = _is_clean() & F.col("page").isNull() & F.col("start").isNotNull()
    return [F.count_if(kind).alias(name) for name, kind in (("corrupt", corrupt), ("error", error), ("page", page), ("start", start))]


def parse_page_log(messages: DataFrame) -> DataFrame:
    """Typed page records from the page topic."""
    return typed(parse_json(messages.select("value"), json_form(PAGE_LOG)).where(F.col(_CORRUPT).isNull()), PAGE_LOG)
