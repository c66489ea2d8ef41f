"""JDBC reads, by the options they hand to Spark. No database is started for a test."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest

from tallyhouse.plans.film_rental import TABLE_KEYS
from tallyhouse.sources import jdbc

DB = jdbc.Database("jdbc:vendor://host/db", "vendor.Driver", {"user": "me", "password": "pw"}, connections=4)


class Reader:
    def __init__(self, log, span):
        self.log, self.span, self.set = log, span, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.set.update(options)
        return self

    def option(self, key, value):
        return self.options(**{key: value})

    def load(self):
        self.log.append(self.set)
        return self

    def first(self):
        return self.span


class Session:
    def __init__(self, span=(1, 100)):
        self.log, self.span = [], span

    @property
    def read(self):
        return Reader(self.log, self.span)


BASE = {
    "url": "jdbc:vendor://host/db", "driver": "vendor.Driver", "fetchsize": "10000", "user": "me", "password": "pw",
}


def test_read_is_divided_by_key():
    session = Session()
    jdbc.read_table(session, DB, "rental", "rental_id")
    assert session.log == [
        {**BASE, "query": "SELECT MIN(rental_id) AS lo, MAX(rental_id) AS hi FROM rental"},
        {
            **BASE, "dbtable": "rental", "partitionColumn": "rental_id",
            "lowerBound": "1", "upperBound": "100", "numPartitions": "4",
        },
    ]


def test_dates_divide_a_read_too():
    session = Session((dt.date(2022, 1, 1), dt.date(2022, 3, 1)))
    jdbc.read_table(session, DB, "orders", "order_date")
    assert session.log[1]["lowerBound"] == "2022-01-01" and session.log[1]["upperBound"] == "2022-03-01"


def test_numbers_bound_a_read_as_whole_ones():
    session = Session((Decimal("5.000"), Decimal("99.500")))
    jdbc.read_table(session, DB, "orders", "id")
    assert session.log[1]["lowerBound"] == "5" and session.log[1]["upperBound"] == "100"


def test_no_key_or_an_empty_table_is_one_read():
    session = Session()
    jdbc.read_table(session, DB, "category")
    assert session.log == [{**BASE, "dbtable": "category"}]
    session = Session((None, None))
    jdbc.read_table(session, DB, "film", "film_id")
    assert session.log[1] == {**BASE, "dbtable": "film"}


def test_all_film_rental_tables():
    session = Session()
    tables = jdbc.read_tables(session, DB, TABLE_KEYS, TABLE_KEYS)
    assert set(tables) == set(TABLE_KEYS) and len(tables) == 11


def test_password_is_not_shown():
    assert "pw" not in repr(DB)


def test_tables_of_a_schema_are_listed(spark, monkeypatch):
    catalog = spark.createDataFrame(
        [("public", "orders"), ("public", "aisles"), ("pg_catalog", "pg_class")], "table_schema STRING, table_name STRING"
    )
    monkeypatch.setattr(Reader, "load", lambda self: self.log.append(self.set) or catalog)
    session = Session()
    got = jdbc.list_tables(session, DB)
    assert sorted(r[0] for r in got.collect()) == ["aisles", "orders"]
    assert session.log == [{**BASE, "dbtable": "information_schema.tables"}]


# --- Ranges by quantiles -----------------------------------------------------------------------------


class Ranked(Reader):
    """Answers the query for bounds by the engine that also runs the SQL of the other tests, and notes what is asked for then."""

    def collect(self):
        return self.span.execute(self.set["query"]).fetchall()

    def jdbc(self, url, table, predicates, properties):
        self.log.append((url, table, predicates, properties))
        return self.span.execute(f"SELECT COUNT(*) FROM {table}").fetchone()


class RankedSession(Session):
    @property
    def read(self):
        return Ranked(self.log, self.span)


def table_of(values, kind="INTEGER"):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE rental (id {kind}, n INTEGER)")
    for v in values:
        con.execute("INSERT INTO rental VALUES (?, 1)", [v])
    return con


def shares(con, predicates):
    return [con.execute(f"SELECT COUNT(*) FROM rental WHERE {p}").fetchone()[0] for p in predicates]


def test_ranges_follow_a_skewed_key():
    """Nearly all keys lie in a hundredth of the span: equal strides would leave them to one connection."""
    con = table_of([*range(1000), 50_000, 100_000, None, None])
    session = RankedSession(con)
    jdbc.read_by_quantiles(session, DB, "rental", "id")
    url, table, predicates, properties = session.log[-1]
    assert (url, table) == (DB.url, "rental")
    assert properties == {"driver": "vendor.Driver", "fetchsize": "10000", "user": "me", "password": "pw"}
    assert predicates == ["id < 251 OR id IS NULL", "id >= 251 AND id < 502", "id >= 502 AND id < 752", "id >= 752"]
    assert shares(con, predicates) == [253, 251, 250, 250]


def test_a_heavy_value_stays_whole_and_nothing_is_lost():
    con = table_of([7] * 500 + list(range(100)) + [None] * 5)
    session = RankedSession(con)
    jdbc.read_by_quantiles(session, DB, "rental", "id")
    parts = shares(con, session.log[-1][2])
    assert len(parts) == 2 and sum(parts) == 605 and max(parts) <= 501 + 150  # the value, and one share of the others


def test_texts_and_times_make_ranges():
    con = table_of(["a'b", "it's", "x", "y", "z", "o'o"], "TEXT")
    session = RankedSession(con)
    jdbc.read_by_quantiles(session, DB, "rental", "id")
    assert sum(shares(con, session.log[-1][2])) == 6 and "''" in " ".join(session.log[-1][2])
    days = [dt.date(2022, 1, 1), dt.date(2022, 2, 1)]
    assert jdbc.ranges("d", days) == ["d < DATE '2022-02-01' OR d IS NULL", "d >= DATE '2022-02-01'"]
    moments = [dt.datetime(2022, 1, 1), dt.datetime(2022, 2, 1, 3, 4, 5, 6)]
    assert jdbc.ranges("t", moments)[1] == "t >= TIMESTAMP '2022-02-01 03:04:05.000006'"
    assert jdbc.ranges("n", [Decimal("1.50"), 2.5, Decimal("3")])[1] == "n >= 2.5 AND n < 3"
    with pytest.raises(TypeError):
        jdbc.ranges("b", [b"a", b"b"])


def test_one_value_or_none_is_one_read():
    for values in ([], [None], [3, 3, 3]):
        session = RankedSession(table_of(values))
        jdbc.read_by_quantiles(session, DB, "rental", "id")
        assert session.log[-1] == {**BASE, "dbtable": "rental"}
