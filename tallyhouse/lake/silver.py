"""Silver layer: typed, cleaned, one row per key, Parquet by load date."""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyhouse.lake.bronze import write_days

log = logging.getLogger(__name__)

# A write tells the counts of fewer days than these apart.
COUNTED_DAYS = 512
_EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class DayCounts:
    """What became of a day's rows; ``rows_in`` is the sum of the other three."""

    rows_in: int = 0
    rows_distinct: int = 0
    rows_duplicate: int = 0
    rows_rejected: int = 0


def clean(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Strings trimmed; rows rejected whose required value is missing or a blank string.

    Types are set by the schema of the read.
    """
    trimmed = df.withColumns(
        {f.name: F.trim(f.name) for f in df.schema.fields if isinstance(f.dataType, StringType)}
    )
    for name in required:
        trimmed = trimmed.filter(present(trimmed, name))
    return trimmed


def present(df: DataFrame, name: str) -> Column:
    """True where a trimmed column has a value; never null."""
    known = F.col(name).isNotNull()
    return known & (F.col(name) != "") if isinstance(df.schema[name].dataType, StringType) else known


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the lowest by ``order``, and by the remaining columns where that is equal.

    A known value comes before null in every column. An aggregate and not a window: repeats of a busy key shrink to
    one row per task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    values = [*order, *rest]
    ranked = [part for i, c in enumerate(values) for part in (F.col(c).isNull().alias(f"no{i}"), F.col(c).alias(f"v{i}"))]
    if not ranked:
        return df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_row"))
    return first.select(*keys, *[F.col(f"_row.v{i}").alias(c) for i, c in enumerate(values)])


def bronze_to_silver(
    bronze: DataFrame, silver_path: str, keys: Sequence[str], order: Sequence[str], one_day: bool = False
) -> dict[dt.date | None, DayCounts]:
    """Cleans and deduplicates whole days of bronze and replaces those days in silver.

    ``keys`` must contain ``load_date``: a day is then complete in itself. What the write took, rejected and kept of each day
    (none: rows without a day) is counted as the rows pass, without a further read; days without any row are not in the result,
    and a write of ``COUNTED_DAYS`` days or more counts nothing.
    These are counts for a log: where an executor is lost in the middle, tasks that run again may count their rows twice
    (which a day without rows stays clear of), and ``checks.load_audit`` counts exactly.
    """
    taken, sound, kept = Observation(), Observation(), Observation()
    rows = clean(_counted(bronze, taken), keys)
    rows = _counted(first_per_key(_counted(rows, sound), keys, order), kept)
    write_days(rows, silver_path, "parquet", gather=not one_day)
    into, valid, distinct = (_per_day(_seen(each)) for each in (taken, sound, kept))
    return {
        day: DayCounts(n, distinct.get(day, 0), valid.get(day, 0) - distinct.get(day, 0), n - valid.get(day, 0))
        for day, n in into.items()
    }


def _counted(df: DataFrame, seen: Observation) -> DataFrame:
    # Equal days share a bin, or come in several, and while there are enough bins others never do: the counts are exact.
    days = F.histogram_numeric(F.unix_date("load_date"), F.lit(COUNTED_DAYS))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.to_json(days).alias("days"))


def _seen(seen: Observation) -> dict:
    try:
        return seen.get
    except Py4JJavaError:  # an input known to be empty is not even looked at
        return {"rows": 0, "days": None}


def _per_day(seen: dict) -> dict[dt.date | None, int]:
    counts: Counter = Counter()
    for one in json.loads(seen["days"] or "[]"):
        counts[_EPOCH + dt.timedelta(days=int(one["x"]))] += int(one["y"])
    if len(counts) >= COUNTED_DAYS:
        log.warning("%d days or more in one write are not counted", COUNTED_DAYS)
        return {}
    without = seen["rows"] - counts.total()
    return dict(counts) | ({None: without} if without else {})
