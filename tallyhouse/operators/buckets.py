"""Named, possibly overlapping groups of rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_buckets(df: DataFrame, key: str, label: str, buckets: Mapping[str, Column]) -> DataFrame:
    """Distinct (key, label) for every bucket whose condition a row meets; a row may be in several."""
    parts = [df.filter(cond).select(key, F.lit(name).alias(label)) for name, cond in buckets.items()]
    return reduce(DataFrame.unionByName, parts).distinct()
