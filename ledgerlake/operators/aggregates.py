"""Identifier statistics that size an increment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def next_identifier_expr(key: str) -> Column:
    """A7 — max + 1, or 1 when there is no row or every value is null."""
    return (F.coalesce(F.max(key), F.lit(0)) + 1).cast("long")


def distinct_with_null_expr(key: str) -> Column:
    """A8 — number of distinct values, a null counting as one more value."""
    return (
        F.count_distinct(F.col(key)) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    ).cast("long")


def id_stats(df: DataFrame, key: str = "id", target: int | Column | None = None) -> DataFrame:
    """One row: ``next_id``, ``distinct_ids`` and, given a ``target``, the
    ``shortfall`` = max(target − distinct_ids, 0)."""
    out = df.agg(next_identifier_expr(key).alias("next_id"), distinct_with_null_expr(key).alias("distinct_ids"))
    if target is not None:
        t = target if isinstance(target, Column) else F.lit(target)
        out = out.withColumn("shortfall", F.greatest(t - F.col("distinct_ids"), F.lit(0)).cast("long"))
    return out
