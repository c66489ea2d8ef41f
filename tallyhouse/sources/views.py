"""Names for DataFrames in SQL text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Makes each table available to ``spark.sql`` under its name, in this session only."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
