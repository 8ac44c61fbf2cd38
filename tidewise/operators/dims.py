"""Dimension lookups.

The dimension side is not hinted: the user table grows with the business, so
Spark broadcasts it only while its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive
execution splits a hot user's rows (left outer joins can split their left side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import age_years


def _lookup(facts: DataFrame, dim: DataFrame, key: str, found: str, strict: bool) -> DataFrame:
    joined = facts.join(dim, facts[key] == dim["_id"], "left").drop("_id")
    if strict:
        missing = F.raise_error(F.concat(F.lit(f"no dimension row for {key} "), F.col(key).cast("string")))
        joined = joined.withColumn(found, F.when(F.col(found), F.lit(True)).otherwise(missing.cast("boolean")))
    return joined


def _key(dim: DataFrame, facts: DataFrame, key: str) -> Column:
    # The dimension id takes the fact key's type, so a fact key is never cast.
    return dim["id"].try_cast(facts.schema[key].dataType).alias("_id")


def enrich_user(
    facts: DataFrame, users: DataFrame, as_of=None, strict: bool = False, keep_found: bool = False
) -> DataFrame:
    """Add ``user_gender`` and ``user_age`` (whole years at ``as_of``).

    A fact without its user keeps its row with NULLs; ``strict`` fails instead.
    """
    dim = users.select(
        _key(users, facts, "user_id"),
        F.col("gender").alias("user_gender"),
        age_years(F.col("birthday"), as_of).alias("user_age"),
        F.lit(True).alias("user_found"),
    )
    joined = _lookup(facts, dim, "user_id", "user_found", strict)
    return _found(joined, "user_found", strict, keep_found)


def enrich_province(
    facts: DataFrame,
    provinces: DataFrame,
    iso_3166_2: str = "province_3166_2",
    strict: bool = False,
    keep_found: bool = False,
) -> DataFrame:
    """Add the province's name and codes; ``iso_3166_2`` names the column for that code."""
    dim = provinces.select(
        _key(provinces, facts, "province_id"),
        F.col("name").alias("province_name"),
        F.col("iso_code").alias("province_iso_code"),
        F.col("iso_3166_2").alias(iso_3166_2),
        F.col("area_code").alias("province_area_code"),
        F.lit(True).alias("province_found"),
    )
    joined = _lookup(facts, dim, "province_id", "province_found", strict)
    return _found(joined, "province_found", strict, keep_found)


def _found(joined: DataFrame, found: str, strict: bool, keep: bool) -> DataFrame:
    if keep:
        return joined.withColumn(found, F.coalesce(found, F.lit(False)))
    if strict:
        # The check must stay in the plan, so it filters rather than being pruned as an unused column.
        return joined.where(found).drop(found)
    return joined.drop(found)


def miss_counts() -> list[Column]:
    """Facts, and how many found no user or no province; over rows enriched with ``keep_found``."""
    return [
        F.count(F.lit(1)).alias("facts"),
        F.count_if(~F.col("user_found")).alias("no_user"),
        F.count_if(~F.col("province_found")).alias("no_province"),
    ]
