"""Joins that stay even when one key holds much of a table.

Plain equi-joins of two scans are left to Spark: it broadcasts a side only below its size threshold and
adaptive execution splits an oversized partition. It cannot split when one side is an aggregate on the
join key, because then that side has no shuffle of its own; ``salted_join`` covers that case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def salted_join(
    many: DataFrame, few: DataFrame, key: str, spread_by: str, hot_rows: int = HOT_ROWS, bound: str | None = None
) -> DataFrame:
    """Inner join of ``many`` to ``few`` on ``key``, with each busy key divided over several partitions.

    A key with more than ``hot_rows`` rows in ``many`` is split into as many shares as it has multiples
    of ``hot_rows``; a row's share comes from the hash of ``spread_by``. Matching rows of ``few`` are
    repeated once per share, so ``few`` should hold few rows per key.

    The rows of ``many`` per key are counted, unless ``few`` has one row per key and its column ``bound`` is at
    least that count. The broadcast list holds busy keys only: it has fewer entries than the counts, or
    bounds, add up to divided by ``hot_rows``.
    """
    if bound is None:
        sizes = many.groupBy(key).agg(F.count("*").alias("_rows"))
    else:
        sizes = few.select(key, F.col(bound).alias("_rows"))
    busy = F.broadcast(
        sizes.filter((F.col("_rows") > hot_rows) & F.col(key).isNotNull()).select(key, _shares("_rows", hot_rows))
    )
    known = few.join(busy, key, "left") if bound is None else few.withColumn("_shares", _shares(bound, hot_rows))
    shares = F.coalesce("_shares", F.lit(1))
    right = known.withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    left = many.join(busy, key, "left").withColumn("_share", F.pmod(F.xxhash64(spread_by), shares).cast("int"))
    return left.drop("_shares").join(right.drop("_shares"), [key, "_share"]).drop("_share")


def _shares(rows: str, hot_rows: int) -> Column:
    return F.greatest(F.ceil(F.col(rows) / hot_rows), F.lit(1)).cast("int").alias("_shares")


def without_match(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; a null key matches nothing and is kept.

    ``other`` is reduced to one row per key first: repeats vanish in the map tasks.
    """
    return df.join(other.select(key).distinct(), key, "left_anti")
