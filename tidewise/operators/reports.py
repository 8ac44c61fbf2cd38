"""The published queries over the stored documents: daily actives, sales by item, paged item detail.

Each takes the document table and filters it by day first, so on a
day-partitioned table only that day's folders are read; a day without documents
gives empty or zero results.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import gender_label, money
from ..functions.text import bm25_term, highlight, matches_all, query_terms, term_frequency, tokens

# Columns of a detail row, and the age bands' labels.
DETAIL_COLUMNS = [
    "create_time",
    "order_price",
    "province_name",
    "sku_name",
    "sku_num",
    "total_amount",
    "user_age",
    "user_gender",
]
AGE_BANDS = ["20岁以下", "20到29岁", "30岁以上"]
STATS_FIELDS = {"age": "user_age", "gender": "user_gender"}
HOURS_PER_DAY = 24
MAX_BUCKETS = 100


def day_before(day: str) -> str:
    return str(datetime.date.fromisoformat(day) - datetime.timedelta(days=1))


# ---- daily actives -------------------------------------------------------------------


def dau_total(dau: DataFrame, day: str) -> DataFrame:
    """One row: documents of the day, 0 for a day without any."""
    return dau.where(F.col("dt") == day).agg(F.count(F.lit(1)).alias("dau_total"))


def dau_by_hour(dau: DataFrame, day: str) -> DataFrame:
    """(hr, n) for the hours that have documents."""
    return dau.where(F.col("dt") == day).groupBy("hr").agg(F.count(F.lit(1)).alias("n"))


def fill_hours(by_hour: DataFrame) -> DataFrame:
    """All 24 hours, zero where there is no count."""
    hours = by_hour.sparkSession.range(HOURS_PER_DAY).select(F.format_string("%02d", "id").alias("hr"))
    return hours.join(by_hour, "hr", "left").select("hr", F.coalesce("n", F.lit(0)).alias("n"))


def dau_summary(dau: DataFrame, day: str) -> DataFrame:
    """One row (dau_total, dau_td, dau_yd): the day's total, and hour -> count for it and the day before.

    Both days are read in one pass; what is gathered is at most 24 counts a day.
    """
    before = day_before(day)
    hourly = dau.where(F.col("dt").isin(day, before)).groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n"))

    def by_hour(of: str) -> Column:
        entries = F.collect_list(F.when(F.col("dt") == of, F.struct("hr", "n")))
        return F.map_from_entries(F.array_sort(entries))

    total = F.coalesce(F.sum(F.when(F.col("dt") == day, F.col("n"))), F.lit(0))
    return hourly.agg(total.alias("dau_total"), by_hour(day).alias("dau_td"), by_hour(before).alias("dau_yd"))


def dau_realtime(dau: DataFrame, day: str) -> DataFrame:
    """The summary in long form, (metric, hr, n): one row for the total, one per hour of either day."""

    def rows(metric: str, counts: str) -> Column:
        return F.transform(
            F.map_entries(counts),
            lambda e: F.struct(F.lit(metric).alias("metric"), e["key"].alias("hr"), e["value"].alias("n")),
        )

    total = F.array(
        F.struct(F.lit("dauTotal").alias("metric"), F.lit(None).cast("string").alias("hr"), F.col("dau_total").alias("n"))
    )
    every = F.concat(total, rows("dauTd", "dau_td"), rows("dauYd", "dau_yd"))
    return dau_summary(dau, day).select(F.inline(every))


def dau_realtime_response(dau: DataFrame, day: str) -> dict:
    """``{dauTotal, dauTd, dauYd}``; 49 numbers at most reach the driver."""
    row = dau_summary(dau, day).first()
    return {"dauTotal": row.dau_total, "dauTd": row.dau_td, "dauYd": row.dau_yd}


# ---- item search ---------------------------------------------------------------------


def _day(wide: DataFrame, day: str) -> DataFrame:
    column = "dt" if "dt" in wide.columns else "create_date"
    return wide.where(F.col(column) == day)


def item_search(wide: DataFrame, item: str, day: str, cjk: bool = False) -> DataFrame:
    """The day's order lines whose item name holds every term of ``item``."""
    terms = query_terms(wide.sparkSession, item, cjk)
    return _day(wide, day).where(matches_all(F.col("sku_name"), terms, cjk))


def _corpus_stats(corpus: DataFrame, terms: list[str], cjk: bool) -> DataFrame:
    """One row over a day: its rows, of them those with a name and their mean length, those per term, and those with all terms."""
    name = F.col("sku_name")
    words = tokens(name, cjk)
    return corpus.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(name).cast("double").alias("docs"),
        F.avg(F.when(name.isNotNull(), F.size(words).cast("double"))).alias("length"),
        F.count_if(matches_all(name, terms, cjk)).alias("total"),
        *[F.count_if(F.array_contains(words, t)).cast("double").alias(f"df{i}") for i, t in enumerate(terms)],
    )


def _score(terms: list[str], stats: Column, cjk: bool) -> Column:
    words = tokens(F.col("sku_name"), cjk)
    length = F.size(words).cast("double")
    score = F.lit(0.0)
    for i, term in enumerate(terms):
        score = score + bm25_term(term_frequency(words, term), length, stats["docs"], stats[f"df{i}"], stats["length"])
    return score


def item_scored(wide: DataFrame, item: str, day: str, cjk: bool = False) -> DataFrame:
    """Matching lines with their BM25 ``score``, corpus = the day's lines that have a name."""
    terms = query_terms(wide.sparkSession, item, cjk)
    corpus = _day(wide, day)
    stats = _corpus_stats(corpus, terms, cjk)
    one = stats.select(F.struct("docs", "length", *[f"df{i}" for i in range(len(terms))]).alias("s"))
    scored = corpus.where(matches_all(F.col("sku_name"), terms, cjk)).withColumn("_s", one.scalar())
    return scored.withColumn("score", _score(terms, F.col("_s"), cjk)).drop("_s")


def postings_scored(postings: DataFrame, stats: DataFrame, terms: list[str]) -> DataFrame:
    """(detail_id, score) of the documents that hold all ``terms``, from the postings of these terms and the day's statistics.

    The same scores as ``item_scored``, without reading or splitting a name.
    """
    if not terms:
        return postings.where(F.lit(False)).select("detail_id", F.lit(0.0).alias("score"))
    day = stats.agg(F.sum("docs").cast("double").alias("docs"), (F.sum("terms") / F.sum("docs")).alias("length"))
    seen = postings.agg(*[F.count_if(F.col("term") == t).cast("double").alias(f"df{i}") for i, t in enumerate(terms)])
    counts = [F.max(F.when(F.col("term") == t, F.col("tf"))).cast("double").alias(f"tf{i}") for i, t in enumerate(terms)]
    found = postings.groupBy("detail_id").agg(F.max("length").cast("double").alias("length"), *counts)
    found = found.withColumn("_day", day.select(F.struct("docs", "length").alias("s")).scalar())
    found = found.withColumn("_seen", seen.select(F.struct(*seen.columns).alias("s")).scalar())
    score, holds = F.lit(0.0), F.lit(True)
    for i in range(len(terms)):
        tf, s, df = F.col(f"tf{i}"), F.col("_day"), F.col("_seen")[f"df{i}"]
        holds = holds & tf.isNotNull()
        score = score + bm25_term(tf, F.col("length"), s["docs"], df, s["length"])
    return found.where(holds).select("detail_id", score.alias("score"))


def item_ranked(wide: DataFrame, item: str, day: str, cjk: bool = False) -> DataFrame:
    """Matching lines in order of relevance, ties by ``detail_id``."""
    return item_scored(wide, item, day, cjk).orderBy(F.col("score").desc(), "detail_id")


def item_highlight(wide: DataFrame, item: str, day: str, cjk: bool = False) -> DataFrame:
    """Matching lines with the terms marked in ``sku_name``."""
    terms = query_terms(wide.sparkSession, item, cjk)
    return item_search(wide, item, day, cjk).withColumn("sku_name", highlight(F.col("sku_name"), terms, cjk))


# ---- sales by item -------------------------------------------------------------------


def item_buckets(wide: DataFrame, item: str, day: str, field: str, cjk: bool = False) -> DataFrame:
    """(key, total_amount, n) per value of ``field``; lines without a value are in no bucket."""
    found = item_search(wide, item, day, cjk).where(F.col(field).isNotNull())
    return found.groupBy(F.col(field)).agg(
        F.sum(money(F.col("split_total_amount"))).cast("double").alias("total_amount"), F.count(F.lit(1)).alias("n")
    )


def top_buckets(buckets: DataFrame, key: str, size: int = MAX_BUCKETS) -> DataFrame:
    """The ``size`` fullest buckets, ties by key."""
    return buckets.orderBy(F.col("n").desc(), key).limit(size)


def stats_by_item(wide: DataFrame, item: str, day: str, t: str, cjk: bool = False) -> DataFrame:
    """(name, value): sales of the item by ``age`` band or by ``gender``."""
    if t not in STATS_FIELDS:
        raise ValueError(f"t must be one of {sorted(STATS_FIELDS)}, not {t!r}")
    field = STATS_FIELDS[t]
    buckets = item_buckets(wide, item, day, field, cjk)
    if t == "age":
        return age_bands(buckets)
    return buckets.select(gender_label(F.col(field)).alias("name"), F.col("total_amount").alias("value"))


def age_bands(buckets: DataFrame) -> DataFrame:
    """Three rows, zeros included, if there is any bucket; none otherwise."""
    age = F.col("user_age").try_cast("int")
    bands = [age < 20, (age >= 20) & (age <= 29), age >= 30]
    sums = [
        F.coalesce(F.sum(F.when(band, money(F.col("total_amount")))), F.lit(0)).cast("double").alias(f"b{i}")
        for i, band in enumerate(bands)
    ]
    one = buckets.agg(F.count(F.lit(1)).alias("buckets"), *sums).where(F.col("buckets") > 0)
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"b{i}").alias("value")) for i, n in enumerate(AGE_BANDS)])
    return one.select(F.inline(rows))


# ---- paged detail --------------------------------------------------------------------


def detail_total(wide: DataFrame, item: str, day: str, cjk: bool = False) -> DataFrame:
    """One row: how many lines match, whatever the page."""
    return item_search(wide, item, day, cjk).agg(F.count(F.lit(1)).alias("total"))


def detail_by_item(
    wide: DataFrame, item: str, day: str, page_no: int = 1, page_size: int = 20, cjk: bool = False
) -> DataFrame:
    """One page of matching lines, best first, with highlighted names.

    Sort plus offset and limit is one top-k per task; the names are marked after
    it, so only the page's rows pay for it.
    """
    if page_no < 1 or page_size < 0:
        raise ValueError("page_no starts at 1 and page_size at 0")
    terms = query_terms(wide.sparkSession, item, cjk)
    needed = [*DETAIL_COLUMNS, "detail_id", "score"]
    page = item_ranked(wide, item, day, cjk).select(*needed).offset((page_no - 1) * page_size).limit(page_size)
    return page.withColumn("sku_name", highlight(F.col("sku_name"), terms, cjk)).select(*DETAIL_COLUMNS)


def detail_after(
    wide: DataFrame,
    item: str,
    day: str,
    after: tuple[float, int] | None = None,
    page_size: int = 20,
    cjk: bool = False,
) -> DataFrame:
    """The page that follows a row given by its (score, detail_id), the first one without; with these two columns.

    What came before is filtered out, so each page is a top-k of ``page_size`` per task, however far into the result.
    """
    if page_size < 0:
        raise ValueError("page_size starts at 0")
    scored = item_scored(wide, item, day, cjk)
    if after is not None:
        score, detail_id = after
        scored = scored.where((F.col("score") < score) | ((F.col("score") == score) & (F.col("detail_id") > detail_id)))
    page = scored.select(*DETAIL_COLUMNS, "score", "detail_id").orderBy(F.col("score").desc(), "detail_id").limit(page_size)
    return page.withColumn("sku_name", highlight(F.col("sku_name"), query_terms(wide.sparkSession, item, cjk), cjk))


def detail_response(
    wide: DataFrame, day: str, item: str, page_no: int = 1, page_size: int = 20, cjk: bool = False
) -> dict:
    """``{total, detail}`` with one page of rows; ``{}`` for a day without documents.

    Two passes over the day: its statistics with the total, and the page scored by them.
    """
    if page_no < 1 or page_size < 0:
        raise ValueError("page_no starts at 1 and page_size at 0")
    terms = query_terms(wide.sparkSession, item, cjk)
    corpus = _day(wide, day)
    stats = _corpus_stats(corpus, terms, cjk).first()
    if not stats["rows"]:
        return {}
    known = F.struct(*[F.lit(stats[n]).cast("double").alias(n) for n in ("docs", "length", *(f"df{i}" for i in range(len(terms))))])
    found = corpus.where(matches_all(F.col("sku_name"), terms, cjk)).withColumn("score", _score(terms, known, cjk))
    best = found.select(*DETAIL_COLUMNS, "score", "detail_id").orderBy(F.col("score").desc(), "detail_id")
    page = best.offset((page_no - 1) * page_size).limit(page_size)
    rows = page.withColumn("sku_name", highlight(F.col("sku_name"), terms, cjk)).select(*DETAIL_COLUMNS).collect()
    return {"total": stats["total"], "detail": [r.asDict() for r in rows]}
