"""Database tables over JDBC, read through several connections.

Connection settings come from the caller; none are stored here. The driver's jar must be on the class path.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Where a database is and how to sign in; ``options`` go to Spark's JDBC reader unchanged."""

    url: str
    driver: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    connections: int = 8
    fetch_rows: int = 10_000

    def reader_options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "fetchsize": str(self.fetch_rows),
            **self.options,
        }


def read_table(spark: SparkSession, db: Database, table: str, key: str | None = None) -> DataFrame:
    """A whole table. With a numeric or date ``key`` it is read in equal key ranges, one per connection.

    The ranges only divide the work: rows outside them and rows with a null key are read as well. Filters
    and column choices on the result reach the database. ``read_by_quantiles`` is for keys that lie unevenly.
    """
    reader = spark.read.format("jdbc").options(**db.reader_options())
    if key is not None and db.connections > 1:
        span = reader.option("query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}").load().first()
        reader = spark.read.format("jdbc").options(**db.reader_options())
        if span is not None and span[0] is not None:
            reader = reader.options(
                partitionColumn=key,
                lowerBound=_bound(span[0], math.floor),
                upperBound=_bound(span[1], math.ceil),
                numPartitions=str(db.connections),
            )
    return reader.option("dbtable", table).load()


def read_by_quantiles(spark: SparkSession, db: Database, table: str, key: str) -> DataFrame:
    """A whole table in ranges of ``key`` that hold about as many rows each, one range per connection.

    For keys that lie unevenly, where equal strides leave most rows to one connection; any type the database orders will do,
    texts included. The database ranks the keys once (an index saves the sort). The ranges cover every value and null, so
    rows that come in between are read as well. A value that fills several ranges alone stays whole, and its ranges are one.
    """
    ranked = f"SELECT {key} AS k, NTILE({db.connections}) OVER (ORDER BY {key}) AS part FROM {table} WHERE {key} IS NOT NULL"
    query = f"SELECT MIN(k) AS lo FROM ({ranked}) ranked GROUP BY part"
    reader = spark.read.format("jdbc").options(**db.reader_options())
    lows = sorted({row[0] for row in reader.option("query", query).load().collect()})
    if len(lows) < 2:
        return spark.read.format("jdbc").options(**db.reader_options()).option("dbtable", table).load()
    options = {name: value for name, value in db.reader_options().items() if name != "url"}
    return spark.read.jdbc(db.url, table, predicates=ranges(key, lows), properties=options)


def ranges(key: str, lows: list) -> list[str]:
    """Conditions that part all rows at the given values, of which the first only begins what lies below the second."""
    cuts = [_literal(low) for low in lows[1:]]
    inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


def _literal(value) -> str:
    """A value in the SQL that databases share."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"no ranges over {value!r}")
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    raise TypeError(f"no ranges over {type(value).__name__}")


def _bound(value, rounded) -> str:
    """Numbers as whole ones, whatever type the database gives them in; dates and times as they are written."""
    return str(rounded(value)) if isinstance(value, (int, float, Decimal)) else str(value)


def list_tables(spark: SparkSession, db: Database, schema: str = "public") -> DataFrame:
    """Names of the tables in one database schema, as ``table_name``."""
    catalog = spark.read.format("jdbc").options(**db.reader_options())
    names = catalog.option("dbtable", "information_schema.tables").load()
    return names.filter(names["table_schema"] == schema).select("table_name")


def read_tables(
    spark: SparkSession, db: Database, tables: Iterable[str], keys: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    keys = keys or {}
    return {table: read_table(spark, db, table, keys.get(table)) for table in tables}
