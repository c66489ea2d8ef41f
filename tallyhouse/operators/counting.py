"""Grouped counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_and_distinct(df: DataFrame, group: str, key: str, rows: str, distinct: str) -> DataFrame:
    """Row count and distinct keys per group.

    Spark plans the single distinct in two steps, first by (group, key) and then by group, so a group
    that holds most of the table is still spread over all tasks.
    """
    return df.groupBy(group).agg(F.count("*").alias(rows), F.countDistinct(key).alias(distinct))


def distinct_where(df: DataFrame, group: Sequence[str], key: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Per group, the number of distinct keys with at least one row meeting each condition.

    Same result as ``count(distinct case when condition then key end)`` for every condition. Several
    such aggregates side by side make Spark copy each row once per condition; one row per (group, key)
    holding a flag per condition needs no copies and shuffles on the key as well as on the group.
    """
    flags = df.groupBy(*group, key).agg(*[F.max(cond).alias(name) for name, cond in conditions.items()])
    return flags.groupBy(*group).agg(
        *[F.count(F.when(F.col(name), F.col(key))).alias(name) for name in conditions]
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and row count of each table. Parquet counts come from file footers."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
