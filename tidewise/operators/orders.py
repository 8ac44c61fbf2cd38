"""Order headers and order lines: parsing, the day-apart join and the wide document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import overlay, pick_one, typed
from ..functions.scalars import date_part, hour_part
from ..schemas import ORDER_DETAIL, ORDER_INFO, ORDER_INFO_WIDE, ORDER_WIDE, json_form
from .dims import enrich_province, enrich_user
from .logs import parse_json

# Fixed value: how far apart a header and its lines may arrive.
JOIN_SECONDS = 24 * 3600
# What makes one header of an order newer than another.
HEADER_VERSION = ("operate_time", "order_status")


def parse_order_info(messages: DataFrame) -> DataFrame:
    return typed(parse_json(messages.select("value"), json_form(ORDER_INFO)).where("_corrupt IS NULL"), ORDER_INFO)


def parse_order_detail(messages: DataFrame) -> DataFrame:
    return typed(parse_json(messages.select("value"), json_form(ORDER_DETAIL)).where("_corrupt IS NULL"), ORDER_DETAIL)


def with_create_parts(infos: DataFrame) -> DataFrame:
    created = F.col("create_time")
    return infos.withColumn("create_date", date_part(created)).withColumn("create_hour", hour_part(created))


def enrich_orders(
    orders: DataFrame, users: DataFrame, provinces: DataFrame, as_of=None, strict: bool = False, keep_found: bool = False
) -> DataFrame:
    """Add user and province columns under the names the order documents use."""
    with_user = enrich_user(orders, users, as_of, strict, keep_found)
    return enrich_province(with_user, provinces, "province_3166_2_code", strict, keep_found)


def order_info_wide(infos: DataFrame, users: DataFrame, provinces: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    """The 22-column order header."""
    enriched = enrich_orders(with_create_parts(infos), users, provinces, as_of, strict)
    return enriched.select(*ORDER_INFO_WIDE.names)


def _seconds_apart() -> Column:
    def at(alias: str) -> Column:
        return F.unix_timestamp(F.try_to_timestamp(F.col(f"{alias}.create_time"), F.lit("yyyy-MM-dd HH:mm:ss")))

    return F.abs(at("d") - at("i"))


def _one_header(infos: DataFrame) -> DataFrame:
    """Collapse re-sent headers before the join, so copies never multiply with the lines.

    The key holds the creation time as well: headers of one order that differ in
    it may each be in or out of reach of a line. It also leaves both sides of
    the join with a shuffle of their own, which adaptive execution can split
    when one order holds a large share of the lines.
    """
    return pick_one(infos, ["id", "create_time"], list(HEADER_VERSION), latest=True)


def _paired(infos: DataFrame, details: DataFrame, how: str = "inner") -> DataFrame:
    on = F.col("d.order_id") == F.col("i.id")
    return details.alias("d").join(_one_header(infos).alias("i"), on, how)


def order_pairs(infos: DataFrame, details: DataFrame) -> DataFrame:
    """Headers (``i``) and lines (``d``) of equal order created at most a day apart; an unknown time counts as near."""
    return _paired(infos, details).where(_near())


def _near() -> Column:
    return F.coalesce(_seconds_apart() <= JOIN_SECONDS, F.lit(True))


def order_wide(infos: DataFrame, details: DataFrame) -> DataFrame:
    """The 30-column order-line document from enriched headers and lines, one per ``detail_id``."""
    return pick_one(wide_of_pairs(order_pairs(infos, details)), ["detail_id"], ["create_date", "order_id"])


def repeated(rows: DataFrame, key: str = "id") -> DataFrame:
    """The keys that more than one row has. Only keys are sent, and counted in place."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(key)


def to_compare(details: DataFrame, headers_again: DataFrame, lines_again: DataFrame, those: bool = True) -> DataFrame:
    """The lines that may make more than one document of a ``detail_id``, or the others: ``those=False``."""
    line, header = lines_again.select(F.col("id").alias("_line")), headers_again.select(F.col("id").alias("_header"))
    by_line, by_header = details["id"].eqNullSafe(line["_line"]), details["order_id"] == header["_header"]
    if not those:
        return details.join(line, by_line, "left_anti").join(header, by_header, "left_anti")
    others = details.join(line, by_line, "left_anti").join(header, by_header, "left_semi")
    return details.join(line, by_line, "left_semi").unionByName(others)


def order_wide_apart(
    infos: DataFrame, details: DataFrame, headers_again: DataFrame, lines_again: DataFrame, compared: DataFrame, their_orders: DataFrame
) -> DataFrame:
    """``order_wide``, with documents compared only where a line or header comes again.

    ``headers_again`` and ``lines_again`` are the ``repeated`` ids of either side, ``compared`` the lines ``to_compare`` and
    ``their_orders`` the ids of their orders, all stored, so that Spark knows how small they are. A line of one row with a
    header of one row makes one document, which needs neither the sort nor the shuffle of the wide rows.
    """
    once = infos.join(headers_again, "id", "left_anti")
    on = F.col("d.order_id") == F.col("i.id")
    pairs = to_compare(details, headers_again, lines_again, those=False).alias("d").join(once.alias("i"), on)
    alone = wide_of_pairs(pairs.where(_near()))
    return alone.unionByName(order_wide(infos.join(their_orders, "id", "left_semi"), compared))


def wide_of_pairs(pairs: DataFrame, info_schema: T.StructType = ORDER_INFO_WIDE) -> DataFrame:
    """Lay lines (``d``) over headers (``i``), so a line's creation time wins even when NULL."""
    fixed = {"detail_id": F.col("d.id"), "order_id": F.col("i.id")}
    return pairs.select(*overlay(ORDER_WIDE, [("i", info_schema), ("d", ORDER_DETAIL)], fixed))


def wide_of_stream_pairs(pairs: DataFrame) -> DataFrame:
    """The document, still without user and province, from joined header and line structs."""
    header = with_create_parts(pairs.select("d", "i.*"))
    names = [c for c in header.columns if c != "d"]
    nested = header.select(F.struct(*names).alias("i"), "d")
    known = T.StructType([f for f in ORDER_INFO_WIDE if f.name in names])
    looked_up = [f.name for f in ORDER_INFO_WIDE if f.name not in names]
    return wide_of_pairs(nested, known).drop(*looked_up)


def late_pairs(infos: DataFrame, details: DataFrame) -> DataFrame:
    """Lines whose header exists but lies more than a day away: the ones the join state has let go."""
    apart = _seconds_apart()
    far = _paired(infos, details).where(apart > JOIN_SECONDS)
    rows = far.select(
        F.col("d.id").alias("detail_id"), F.col("i.id").alias("order_id"), apart.cast("bigint").alias("seconds_apart")
    )
    return rows.groupBy("detail_id").agg(F.min("order_id").alias("order_id"), F.min("seconds_apart").alias("seconds_apart"))


def order_full_outer(infos: DataFrame, details: DataFrame) -> DataFrame:
    """Headers and lines by order, unmatched ones of either side kept.

    Written as lines left-joined to headers plus headers without lines: a full
    outer join cannot be split when one order is hot, a left join can, and the
    second part sees each order of the lines only once.
    """
    matched = _paired(infos, details, "left").select(*_outer_columns())
    with_lines = details.select(F.col("order_id").alias("id")).distinct()
    alone = _one_header(infos).join(with_lines, "id", "left_anti").alias("i")
    lonely = alone.select(
        F.col("i.id").alias("order_id"),
        F.col("i.id").alias("info_id"),
        F.lit(None).cast("bigint").alias("detail_id"),
        F.col("i.total_amount").alias("total_amount"),
        F.lit(None).cast("double").alias("split_total_amount"),
    )
    return matched.unionByName(lonely)


def _outer_columns() -> list[Column]:
    return [
        F.coalesce("i.id", "d.order_id").alias("order_id"),
        F.col("i.id").alias("info_id"),
        F.col("d.id").alias("detail_id"),
        F.col("i.total_amount").alias("total_amount"),
        F.col("d.split_total_amount").alias("split_total_amount"),
    ]
