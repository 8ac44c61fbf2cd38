"""Dashboard figures over the last days of page logs and order documents.

The dashboard asks for these by a number of ``days``; only the shape of each
answer is given, so the definitions are this project's own. A visit begins at
an entry page (``sessions``) and bounces if it saw that page only.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import money
from .sessions import visits
from .uv import uv_period

DEFAULT_DAYS = 7
TOP = 7

# The stages of the conversion funnel and the page each stands for.
FUNNEL = [
    ("首页", "home"),
    ("商品详情", "good_detail"),
    ("加购物车", "cart"),
    ("订单", "trade"),
    ("支付", "payment"),
]
# The rows of the old-against-new comparison.
VISIT_METRICS = ["浏览量", "访客数", "跳出率", "平均访问时长", "平均访问页面数"]


def last_days(rows: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """The rows of ``days`` days up to ``day``; seven where the number is missing or below one."""
    length = days if days and days >= 1 else DEFAULT_DAYS
    first = datetime.date.fromisoformat(day) - datetime.timedelta(days=length - 1)
    return rows.where(F.col("dt").between(str(first), day))


# ---- page logs -----------------------------------------------------------------------


def pv_count(pages: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """(dt, pv): pages seen per day."""
    return last_days(pages, day, days).groupBy("dt").agg(F.count(F.lit(1)).alias("pv"))


def uv_count(pages: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """(dt, uv): devices per day."""
    return last_days(pages, day, days).groupBy("dt").agg(F.count_distinct("mid").alias("uv"))


def _is_new() -> Column:
    return F.max(F.when(F.col("is_new") == "1", 1).otherwise(0)).alias("is_new")


def visit_total_of(counts: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The same from a period's pages per day (``pv_count``) and its days' bitmaps (``uv``)."""
    pages = counts.agg(F.coalesce(F.sum("pv"), F.lit(0)).alias("pv_count"))
    return uv_period(bitmaps).select(pages.scalar().alias("pv_count"), "uv_count", "new_count")


def visit_total(pages: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """One row: pages, devices and new devices of the period."""
    devices = last_days(pages, day, days).groupBy("mid").agg(F.count(F.lit(1)).alias("pv"), _is_new())
    return devices.agg(
        F.coalesce(F.sum("pv"), F.lit(0)).alias("pv_count"),
        F.count("mid").alias("uv_count"),
        F.coalesce(F.sum(F.when(F.col("mid").isNotNull(), F.col("is_new"))), F.lit(0)).alias("new_count"),
    )


def _bounce_rate() -> Column:
    return F.avg(F.when(F.col("pages") == 1, 1.0).otherwise(0.0))


def new_visit_stats(pages: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """(metric, old, new): pages, devices, bounce rate, mean seconds and mean pages per visit, of old and new devices' visits."""
    seen = visits(last_days(pages, day, days))
    figures = [
        F.sum("pages").cast("double"),
        F.count_distinct("mid").cast("double"),
        _bounce_rate(),
        F.sum("millis") / 1000 / F.count(F.lit(1)),
        F.sum("pages") / F.count(F.lit(1)),
    ]
    by_kind = seen.groupBy("is_new").agg(*[f.alias(f"f{i}") for i, f in enumerate(figures)])
    one = by_kind.agg(
        *[
            F.max(F.when(F.col("is_new") == kind, F.col(f"f{i}"))).alias(f"f{i}_{kind}")
            for i in range(len(figures))
            for kind in (0, 1)
        ]
    )
    rows = [
        F.struct(F.lit(name).alias("metric"), F.col(f"f{i}_0").alias("old"), F.col(f"f{i}_1").alias("new"))
        for i, name in enumerate(VISIT_METRICS)
    ]
    return one.select(F.inline(F.array(*rows)))


def channel(pages: DataFrame, day: str, t: str = "pv", days: int | None = None) -> DataFrame:
    """(name, value): page views (``pv``) or bounce rate (``br``) by channel; a visit's is that of its first page."""
    period = last_days(pages, day, days)
    if t == "pv":
        return period.groupBy(F.col("channel").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    if t == "br":
        return visits(period).groupBy(F.col("channel").alias("name")).agg(_bounce_rate().alias("value"))
    raise ValueError(f"t must be 'pv' or 'br', not {t!r}")


def page_path(pages: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """(source, target, value): how often one page led to another."""
    moves = last_days(pages, day, days).where(F.col("last_page_id") != "")
    by = [F.col("last_page_id").alias("source"), F.col("page_id").alias("target")]
    return moves.groupBy(*by).agg(F.count(F.lit(1)).alias("value"))


def user_action_convert(pages: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """(stage, n): devices that reached each stage, zeros included."""
    period = last_days(pages, day, days).where(F.col("page_id").isin([page for _, page in FUNNEL]))
    reached = period.groupBy("page_id").agg(F.count_distinct("mid").alias("n"))
    one = reached.agg(*[F.coalesce(F.max(F.when(F.col("page_id") == p, F.col("n"))), F.lit(0)).alias(p) for _, p in FUNNEL])
    return one.select(F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(p).alias("n")) for s, p in FUNNEL])))


# ---- orders --------------------------------------------------------------------------


def _orders(wide: DataFrame, day: str, days: int | None) -> DataFrame:
    """One row per order: its buyer, province and amount stand on each of its lines alike."""
    facts = [F.max(c).alias(c) for c in ("user_id", "province_name", "total_amount")]
    return last_days(wide, day, days).groupBy("order_id").agg(*facts)


def order_total(wide: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """One row: orders, their amount and their buyers."""
    return _orders(wide, day, days).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.coalesce(F.sum(money(F.col("total_amount"))).cast("double"), F.lit(0.0)).alias("order_amount"),
        F.count_distinct("user_id").alias("order_user"),
    )


def area(wide: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """(name, value): orders per province."""
    return _orders(wide, day, days).groupBy(F.col("province_name").alias("name")).agg(F.count(F.lit(1)).alias("value"))


def user_paid(users: DataFrame, wide: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """(name, value): users who bought and who did not."""
    buyers = last_days(wide, day, days).select(F.col("user_id").alias("id")).distinct().withColumn("paid", F.lit(1))
    known = users.select("id").join(buyers, "id", "left").agg(F.count("paid").alias("paid"), F.count(F.lit(1)).alias("n"))
    rows = F.array(
        F.struct(F.lit("paid").alias("name"), F.col("paid").alias("value")),
        F.struct(F.lit("unpaid").alias("name"), (F.col("n") - F.col("paid")).alias("value")),
    )
    return known.select(F.inline(rows))


def user_total(
    users: DataFrame, pages: DataFrame, wide: DataFrame, day: str, days: int | None = None
) -> DataFrame:
    """One row: users, users new in the period, and the amount per buyer."""
    total = users.agg(F.count(F.lit(1)).alias("n"))
    fresh = last_days(pages, day, days).where(F.col("is_new") == "1").agg(F.count_distinct("user_id").alias("n"))
    sold = order_total(wide, day, days).select(
        F.when(F.col("order_user") > 0, F.col("order_amount") / F.col("order_user")).otherwise(0.0).alias("pct")
    )
    return sold.select(total.scalar().alias("user_count"), fresh.scalar().alias("new_count"), "pct")


def top_sales(
    wide: DataFrame, day: str, by: str, num: int = TOP, days: int | None = None, skus: DataFrame | None = None
) -> DataFrame:
    """(name, value): the ``num`` best-selling values of ``by``, a column of the documents or of ``skus`` (by ``sku_id``).

    Sales are summed per item before the item table is joined.
    """
    lines = last_days(wide, day, days)
    amount = F.sum(money(F.col("split_total_amount"))).alias("amount")
    if skus is not None:
        sold = lines.groupBy("sku_id").agg(amount).join(skus.select("sku_id", by), "sku_id", "left")
        sums = sold.groupBy(by).agg(F.sum("amount").alias("amount"))
    else:
        sums = lines.groupBy(by).agg(amount)
    named = sums.where(F.col(by).isNotNull()).select(F.col(by).alias("name"), F.col("amount").cast("double").alias("value"))
    return named.orderBy(F.col("value").desc(), "name").limit(num)
