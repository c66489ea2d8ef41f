"""Column profiles with typed results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """One row per column: non-null count, mean, sample standard deviation, minimum, maximum.

    Without ``columns``, every numeric column of the table. All columns are measured in one pass; only the single
    result row is turned into rows afterwards.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    if not columns:
        raise ValueError("there is no numeric column to measure")
    stats = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(name).alias("count"),
                F.round(F.avg(name), digits).alias("mean"),
                F.round(F.stddev_samp(name), digits).alias("stddev"),
                F.min(name).cast("double").alias("min"),
                F.max(name).cast("double").alias("max"),
            )
            for name in columns
        ]
    )
    return df.agg(stats.alias("stats")).select(F.inline("stats"))
