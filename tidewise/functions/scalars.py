"""Scalar expressions: dates, ages, codes and labels."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TABLE_TOPIC_PREFIX, TABLE_TOPIC_SUFFIX

# Change types and the one-letter code each maps to.
OP_CODES = {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D"}

# Labels shown for the gender codes.
GENDER_LABELS = {"F": "女", "M": "男"}


def as_date(value: Column | str | datetime.date | None) -> Column:
    """A date column; ``None`` means the day of processing."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.try_cast("date")
    return F.lit(str(value)).try_cast("date")


def age_years(birthday: Column, as_of: Column | str | datetime.date | None = None) -> Column:
    """Completed calendar years between two dates, truncated toward zero."""
    born, now = birthday.try_cast("date"), as_date(as_of)
    months = (F.year(now) - F.year(born)) * 12 + F.month(now) - F.month(born)
    days = F.dayofmonth(now) - F.dayofmonth(born)
    whole = (
        F.when((months > 0) & (days < 0), months - 1)
        .when((months < 0) & (days > 0), months + 1)
        .otherwise(months)
    )
    return (whole / 12).cast("int")


def day_text(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")


def hour_text(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "HH")


def date_part(text: Column) -> Column:
    """``yyyy-MM-dd`` of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.get(F.split(text, " "), F.lit(0))


def hour_part(text: Column) -> Column:
    """``HH`` of a ``yyyy-MM-dd HH:mm:ss`` text; NULL when there is no time part."""
    return F.get(F.split(F.get(F.split(text, " "), F.lit(1)), ":"), F.lit(0))


def op_code(change_type: Column) -> Column:
    """I, U or D; NULL for every other change type."""
    code = F.lit(None).cast("string")
    for name, letter in OP_CODES.items():
        code = F.when(change_type == name, F.lit(letter)).otherwise(code)
    return code


def table_topic(table: Column, op: Column) -> Column:
    return F.concat(F.lit(TABLE_TOPIC_PREFIX), F.upper(table), F.lit("_"), op, F.lit(TABLE_TOPIC_SUFFIX))


def gender_label(code: Column) -> Column:
    label = code
    for name, text in GENDER_LABELS.items():
        label = F.when(code == name, F.lit(text)).otherwise(label)
    return label


def money(amount: Column) -> Column:
    """Exact form for summing, so a total does not depend on row order."""
    return amount.cast("decimal(18,2)")
