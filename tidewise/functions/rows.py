"""Row-level helpers built from plain DataFrame operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool = False) -> DataFrame:
    """One row per key: the least (or greatest) by ``order``, ties by the other columns.

    Spark turns "row number = 1" into a group limit on both sides of the shuffle:
    a task sends at most one row per key, so a key that holds a third of the
    table does not land whole in one sort.
    """
    rest = [*order, *(c for c in df.columns if c not in keys and c not in order)]
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() if latest else F.col(c).asc() for c in rest])
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")


def overlay(
    target: T.StructType,
    sources: Sequence[tuple[str, T.StructType]],
    fixed: Mapping[str, Column] | None = None,
) -> list[Column]:
    """Columns of ``target`` filled from aliased sources by equal name and type.

    A later source wins, its NULLs included; fields no source has are NULL.
    ``fixed`` gives columns that do not follow the name rule.
    """
    out = []
    for field in target:
        if fixed and field.name in fixed:
            column = fixed[field.name]
        else:
            column = F.lit(None)
            for alias, schema in sources:
                if field.name in schema.names and schema[field.name].dataType == field.dataType:
                    column = F.col(f"{alias}.{field.name}")
        out.append(column.cast(field.dataType).alias(field.name))
    return out


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to a schema; text that is no number becomes NULL."""
    return df.select(
        *[
            F.col(f.name) if f.dataType == T.StringType() else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
