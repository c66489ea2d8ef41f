"""Top rows, with and without ties, over a whole result or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The k largest rows. Each task keeps k rows before they meet; ties go by ``tie_break``."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *tie_break).limit(k)


def top_k_with_ties(df: DataFrame, measure: str, k: int, rank: str) -> DataFrame:
    """Rows whose ``rank() over (order by measure desc nulls last)`` is at most k, with that rank.

    A window without a partition key would bring every tied row into one task, and nothing bounds the
    number of ties. The k largest values decide everything: a row is kept if it reaches the smallest of
    them, and its rank is one more than how many of them exceed it. They are a scalar subquery of k
    values, and the rows stay where they are. Null measures rank after all others.
    """
    top = df.orderBy(F.col(measure).desc_nulls_last()).limit(k).agg(F.collect_list(measure)).scalar()
    value = F.col(measure)
    kept = df.withColumn("_top", top).filter(
        (value >= F.array_min("_top")) | (value.isNull() & (F.size("_top") < k))
    )
    above = F.when(value.isNull(), F.size("_top")).otherwise(F.size(F.filter("_top", lambda other: other > value)))
    return kept.withColumn(rank, (above + 1).cast("bigint")).drop("_top")


def first_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first k rows of each group. Spark keeps only k rows per group and task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")
