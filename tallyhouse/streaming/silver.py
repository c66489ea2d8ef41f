"""Incremental bronze -> silver: each landed file is taken up once, in any order of arrival.

A stateful deduplication would keep every key in memory, send all copies of a busy key to one task and
drop rows older than its watermark. A key contains its load date here, so a new file can only change its own
day: the stream tells which days have new files, and those days are rebuilt from bronze and replaced.
Late files are never lost, and a batch that runs twice, for instance after a failure, gives the same table.

The stream only notes the days, batch by batch. When it has taken up everything, each noted day is rebuilt once,
however many files and batches it came in; a call that fails before that leaves its notes to the next. What a day holds is
decided from bronze when it is rebuilt, never from a note: it may have been reloaded or cleared in between.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse import workdir
from tallyhouse.lake.bronze import CLEARED, CLEARED_SCHEMA, clear_day
from tallyhouse.lake.silver import COUNTED_DAYS, DayCounts, bronze_to_silver, clean
from tallyhouse.sources.files import READ_OPTIONS, read_days

log = logging.getLogger(__name__)

_NOTES = "load_date DATE"


def refresh_silver(
    spark: SparkSession,
    bronze: str,
    schema: StructType | str,
    silver: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    fmt: str = "json",
    files_per_batch: int | None = None,
) -> dict[dt.date, DayCounts]:
    """Takes up all files landed since the last call; the counts of each day that was rebuilt. ``schema`` includes ``load_date``.

    ``checkpoint`` remembers which files are done; use the same one on every call for a silver table. A day that the
    bronze layer was left without rows (``clear_day``) is emptied in silver too. A file without any row says nothing
    about its day: the freshness gate belongs before the load.
    """
    landed = spark.readStream.format(fmt).schema(schema).options(**READ_OPTIONS[fmt])
    if files_per_batch is not None:
        landed = landed.option("maxFilesPerTrigger", files_per_batch)
    notes = f"{checkpoint.rstrip('/')}-days"

    def note(batch: DataFrame, batch_id: int) -> None:
        """One row per load date; a batch that runs again replaces its own."""
        seen = batch.dropna(subset=["load_date"]).select("load_date").distinct()
        seen.coalesce(1).write.mode("overwrite").parquet(f"{notes}/batch={batch_id}")

    query = (
        landed.load(bronze)
        .select("load_date")
        .writeStream.foreachBatch(note)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _rebuild(spark, bronze, schema, silver, notes, keys, order, fmt)


def _rebuild(spark, bronze, schema, silver, notes, keys, order, fmt) -> dict[dt.date, DayCounts]:
    batches = workdir.folders_in(spark, notes)
    # The days noted since the last call: their number is bounded by the calendar, not by the data.
    noted: list[dt.date] = []
    if batches:
        rows = spark.read.schema(_NOTES).parquet(*[f"{notes}/{batch}" for batch in batches])
        noted = sorted(r["load_date"] for r in rows.distinct().toLocalIterator())
    counts: dict[dt.date, DayCounts] = {}
    if noted:
        log.info("%d day(s) to rebuild in %s", len(noted), silver)
        for first in range(0, len(noted), COUNTED_DAYS - 1):
            days = noted[first : first + COUNTED_DAYS - 1]
            touched = read_days(spark, bronze, fmt, schema, days)
            written = bronze_to_silver(touched, silver, keys, order, one_day=len(days) == 1)
            counts |= {day: written.get(day, DayCounts()) for day in days}
    # A day of which nothing was written is emptied: its rows were all replaced by unusable ones, or by none.
    empty = [day for day in noted if not counts[day].rows_distinct]
    present = {name.partition("=")[2] for name in workdir.folders_in(spark, silver)}
    cleared = [day for day in _cleared_days(spark, bronze) if day not in counts and day.isoformat() in present]
    if cleared:
        # Days that were cleared once and have rows in silver: all of them are looked up in one pass.
        rows = clean(read_days(spark, bronze, fmt, schema, cleared), keys).select("load_date").distinct()
        full = {r["load_date"] for r in rows.toLocalIterator()}
        empty += [day for day in cleared if day not in full]
    for day in sorted(empty):
        _empty(spark, silver, day, schema)
    for batch in batches:
        workdir.remove(spark, f"{notes}/{batch}")
    return counts


def _cleared_days(spark: SparkSession, bronze: str) -> list[dt.date]:
    if CLEARED not in workdir.folders_in(spark, bronze):
        return []
    rows = spark.read.schema(CLEARED_SCHEMA).parquet(f"{bronze.rstrip('/')}/{CLEARED}").distinct()
    return [row["load_date"] for row in rows.toLocalIterator()]


def _empty(spark: SparkSession, silver: str, day: dt.date, schema: StructType | str) -> None:
    """Removes a day's folder; the last one left stays as an empty table, so that silver can still be read."""
    folder = f"load_date={day.isoformat()}"
    days = [name for name in workdir.folders_in(spark, silver) if name.startswith("load_date=")]
    if folder in days and len(days) > 1:
        log.info("no rows for %s in %s", day, silver)
        workdir.remove(spark, f"{silver.rstrip('/')}/{folder}")
    elif folder in days:
        nothing = spark.createDataFrame([], schema).drop("load_date")
        clear_day(nothing, silver, day, "parquet")
