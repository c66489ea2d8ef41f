"""Bronze layer: data as delivered, one folder per load date."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tallyhouse.sources import jdbc
from tallyhouse.sources.files import WRITE_OPTIONS, marked

log = logging.getLogger(__name__)

# Multi-line CSV is read one file per task, so no file may grow with the table: neither in rows nor in bytes.
MAX_FILE_ROWS = 1_000_000
# Tables of a source that land at the same time.
TABLES_AT_ONCE = 4
# Days left without rows, as a table below the bronze table; readers of the table pass names that begin like this over.
CLEARED = "_cleared"
CLEARED_SCHEMA = "load_date DATE"


class LandingError(RuntimeError):
    """Tables that could not be landed; the others were. ``failed`` has the error of each by name."""

    def __init__(self, source: str, failed: Mapping[str, Exception]):
        super().__init__(f"{source}: not landed: {', '.join(failed)}")
        self.failed = dict(failed)


def write_days(
    df: DataFrame, path: str, fmt: str, mode: str = "overwrite", day: str = "load_date", gather: bool = True
) -> None:
    """Writes by day. ``overwrite`` replaces the days present in ``df`` and leaves all others alone.

    The rebalance step gathers each day into few files, and adaptive execution divides a day that is
    larger than its target size, so neither many small files nor one huge task comes out of it. Where
    all rows belong to the same day, ``gather=False`` saves that shuffle for files that several tasks can read; a CSV
    file is read by one, so rows for those are dealt out by bytes all the same, by a hash of their values.

    The size of a file is that of a partition, ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: a million short
    rows and some hundred long texts both come out near it.
    """
    log.info("writing %s to %s (%s)", fmt, path, mode)
    rows = marked(df) if fmt == "csv" else df
    if gather:
        rows = rows.hint("rebalance", day)
    elif fmt == "csv":
        rows = dealt_by_values(rows, day)
    (
        rows
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_FILE_ROWS)
        .options(**WRITE_OPTIONS[fmt])
        .partitionBy(day)
        .format(fmt)
        .save(path)
    )


def dealt_by_values(df: DataFrame, day: str = "load_date") -> DataFrame:
    """Rows dealt out by a hash of all their values, and adaptive execution makes partitions of the target size of them.

    Without columns to deal by, Spark deals in turns, and so that a task that runs again deals alike, it first sorts all
    that the task has read, which costs more than the rest of the task and needs memory for all its rows. A row's values
    are the same whenever the task runs. Rows alike in every column stay together, as far as one task has read them.
    """
    columns = [f.name for f in df.schema.fields if f.name != day and not isinstance(f.dataType, (MapType, VariantType))]
    return df.hint("rebalance", *[f"`{name.replace('`', '``')}`" for name in columns])


def ingest_day(df: DataFrame, path: str, load_date: dt.date, fmt: str) -> None:
    """Loads one day, replacing what an earlier run of the same day left.

    The earlier rows stay until the new ones are complete, so a run that fails loses nothing. ``df`` is evaluated
    once: its rows are counted as they are written.
    """
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    write_days(rows.withColumn("load_date", F.lit(load_date).cast("date")), path, fmt, gather=False)
    if not written.get["rows"]:
        clear_day(df, path, load_date, fmt)


def clear_day(df: DataFrame, path: str, load_date: dt.date, fmt: str) -> None:
    """Leaves a day without rows, which a write that replaces only days present cannot do, and notes the day.

    No new file tells a stream of this, so ``refresh_silver`` looks at the notes.
    """
    log.info("no rows for %s in %s", load_date, path)
    root = path.rstrip("/")
    (
        df.limit(0)
        .write.mode("overwrite")
        .options(**WRITE_OPTIONS[fmt])
        .format(fmt)
        .save(f"{root}/load_date={load_date.isoformat()}")
    )
    note = df.sparkSession.range(1, numPartitions=1).select(F.lit(load_date).cast("date").alias("load_date"))
    note.write.mode("append").parquet(f"{root}/{CLEARED}")


def format_for(df: DataFrame, fmt: str) -> str:
    """``fmt``, or JSON where that is CSV and a column holds an array, map or record."""
    nested = any(isinstance(f.dataType, (ArrayType, MapType, StructType)) for f in df.schema.fields)
    return "json" if fmt == "csv" and nested else fmt


def land_tables(
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
    path: str,
    source: str,
    load_date: dt.date,
    fmt: str = "csv",
    at_once: int = TABLES_AT_ONCE,
) -> dict[str, str]:
    """Copies whole tables to ``path/<source>/<table>/load_date=<day>``; the format each was written in.

    ``at_once`` tables land at the same time, each as a job of its own, so that a small table does not wait for a large one
    and the cores that a large one leaves free are used. Under Spark's fair scheduler each has a pool of its own.
    A table may be given as a function that opens it. One that fails does not keep the others from landing; in the
    end a failure raises ``LandingError``, so the day is not taken as loaded. Running it again replaces it.
    """

    def land(name: str, table: DataFrame | Callable[[], DataFrame]) -> str:
        df = table() if callable(table) else table
        df.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", f"land-{source}-{name}")
        kind = format_for(df, fmt)
        ingest_day(df, f"{path}/{source}/{name}", load_date, kind)
        return kind

    formats: dict[str, str] = {}
    failed: dict[str, Exception] = {}
    # The caller's job group, tags and description hold in the threads too.
    inheriting = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(max(1, at_once), thread_name_prefix=f"land-{source}") as pool:
        started = {name: pool.submit(inheriting(land), name, table) for name, table in tables.items()}
        for name, job in started.items():
            try:
                formats[name] = job.result()
            except Exception as error:
                log.error("%s.%s was not landed", source, name, exc_info=error)
                failed[name] = error
    if failed:
        raise LandingError(source, failed)
    return formats


def land_database(
    spark: SparkSession,
    db: jdbc.Database,
    path: str,
    source: str,
    load_date: dt.date,
    schema: str = "public",
    keys: Mapping[str, str] | None = None,
    fmt: str = "csv",
    at_once: int = TABLES_AT_ONCE,
    by_quantiles: bool = False,
) -> dict[str, str]:
    """Lists the tables of a database schema and lands each, as ``land_tables`` does. ``keys`` divide the reads, into equal
    strides or, ``by_quantiles``, into ranges of about equally many rows.

    At most ``at_once`` times ``db.connections`` connections are open.
    """
    names = sorted(row["table_name"] for row in jdbc.list_tables(spark, db, schema).toLocalIterator())
    log.info("%s: %d table(s)", source, len(names))

    def opened(name: str) -> Callable[[], DataFrame]:
        key = (keys or {}).get(name)
        if by_quantiles and key is not None:
            return lambda: jdbc.read_by_quantiles(spark, db, name, key)
        return lambda: jdbc.read_table(spark, db, name, key)

    return land_tables({name: opened(name) for name in names}, path, source, load_date, fmt, at_once)
