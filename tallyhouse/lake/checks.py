"""Freshness gate and load audit."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyhouse.lake.silver import DayCounts, present

log = logging.getLogger(__name__)


class MissingLoadError(RuntimeError):
    """A day that should have been loaded holds no rows."""


def missing_days(spark: SparkSession, df: DataFrame, day: str, first: dt.date, last: dt.date) -> DataFrame:
    """The days from first to last, both included, without any row.

    Only rows of these days are read where the table is laid out, or its files sorted, by day.
    """
    expected = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias(day)
    )
    loaded = df.filter(F.col(day).between(F.lit(first), F.lit(last)))
    return expected.join(loaded.select(day).distinct(), day, "left_anti")


def require_day(df: DataFrame, load_date: dt.date, name: str, day: str = "load_date") -> None:
    """Fails the job when a day is empty. On a date-partitioned table only that day's folder is read."""
    if df.filter(F.col(day) == F.lit(load_date)).isEmpty():
        message = f"{name}: no data for {load_date}"
        log.error(message)
        raise MissingLoadError(message)
    log.info("%s: data found for %s", name, load_date)


def load_audit(df: DataFrame, keys: Sequence[str], day: str = "load_date") -> DataFrame:
    """Per day: rows in, distinct keys, duplicates, rejects; rows_in is the sum of the other three.

    Keys are trimmed and rejected as ``silver.clean`` does, and so is a row without a day: rows_distinct is what the
    silver layer keeps of the day. Rows are first counted per (day, key), so a day or key that holds most of the
    table is reduced before it moves.
    """
    trimmed = df.select(
        day, *[F.trim(key).alias(key) if isinstance(df.schema[key].dataType, StringType) else key for key in keys]
    )
    per_key = trimmed.groupBy(day, *keys).agg(F.count("*").alias("_rows"))
    valid = F.col(day).isNotNull()
    for key in keys:
        valid = valid & present(trimmed, key)
    rows = F.col("_rows")
    return per_key.groupBy(day).agg(
        F.sum(rows).alias("rows_in"),
        F.count(F.when(valid, 1)).alias("rows_distinct"),
        F.coalesce(F.sum(F.when(valid, rows - 1)), F.lit(0)).cast("bigint").alias("rows_duplicate"),
        F.coalesce(F.sum(F.when(~valid, rows)), F.lit(0)).cast("bigint").alias("rows_rejected"),
    )


def log_audit(audit: DataFrame, name: str, day: str = "load_date") -> None:
    """Writes one log line per day; the audit has one row per load date."""
    for row in audit.orderBy(day).toLocalIterator():
        _log_day(name, row[day], DayCounts(row["rows_in"], row["rows_distinct"], row["rows_duplicate"], row["rows_rejected"]))


def log_counts(counts: Mapping[dt.date | None, DayCounts], name: str) -> None:
    """The same lines for what a write to silver counted on its way."""
    for day in sorted(counts, key=lambda day: (day is not None, day)):
        _log_day(name, day, counts[day])


def _log_day(name: str, day: dt.date | None, n: DayCounts) -> None:
    log.info(
        "%s %s: in=%d distinct=%d duplicate=%d rejected=%d",
        name, day, n.rows_in, n.rows_distinct, n.rows_duplicate, n.rows_rejected,
    )
