"""The seven questions on small film-rental tables, against plain SQL in DuckDB and by hand."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyhouse.plans import film_rental
from tallyhouse.sources.views import register_views

SCHEMAS = {
    "category": "category_id INT, name STRING",
    "film_category": "film_id INT, category_id INT",
    "film": "film_id INT, title STRING",
    "film_actor": "film_id INT, actor_id INT",
    "actor": "actor_id INT, first_name STRING, last_name STRING",
    "inventory": "inventory_id INT, film_id INT",
    "rental": (
        "rental_id INT, inventory_id INT, customer_id INT, rental_date TIMESTAMP_NTZ, return_date TIMESTAMP_NTZ"
    ),
    "payment": "rental_id INT, amount DECIMAL(5,2)",
    "customer": "customer_id INT, address_id INT, active INT",
    "address": "address_id INT, city_id INT",
    "city": "city_id INT, city STRING",
}
CITIES = ["Aden", "abha", "Ash-Sham", "Bern", "Baden-Baden", "a_x", "A%", "Oslo", "Zug", "Tel-Aviv"]


def make_rows(seed):
    rnd = random.Random(seed)
    films, actors, customers = 40, 25, 60
    rows = {
        "category": [(i, n) for i, n in enumerate(["Children", "Action", "Drama", "Music", "Travel"], 1)],
        "film": [(i, f"Film {i % 30}") for i in range(1, films + 1)],
        "city": list(enumerate(CITIES, 1)),
        "address": [(i, rnd.choice([*range(1, 11), None])) for i in range(1, 41)],
        # Two people share a name; one has no last name.
        "actor": [(i, f"F{i % 12}", None if i == 7 else f"L{i % 12}") for i in range(1, actors + 1)],
    }
    rows["film_category"] = [(f, c) for f in range(1, films + 1) for c in rnd.sample(range(1, 6), rnd.choice([1, 2]))]
    rows["film_category"] += rows["film_category"][:3] + [(999, 1)]
    rows["film_actor"] = [(f, a) for f in range(1, films + 1) for a in rnd.sample(range(1, actors + 1), rnd.randint(1, 4))]
    rows["film_actor"] += [(5, a) for a in range(1, actors + 1)] + [(999, 2)]
    rows["inventory"] = [(i, rnd.choice([*range(1, 31), 5, 5, 5, 5, 999, None])) for i in range(1, 121)]
    start = dt.datetime(2005, 5, 1)
    rows["rental"] = []
    for i in range(1, 901):
        out = start + dt.timedelta(minutes=rnd.randint(0, 200_000))
        back = rnd.choice([None, out + dt.timedelta(minutes=rnd.randint(-5_000, 20_000))])
        # One copy is out a third of the time.
        rows["rental"].append((i, 7 if rnd.random() < 0.33 else rnd.randint(1, 130), rnd.randint(1, 70), out, back))
    rows["payment"] = [
        (rnd.randint(1, 950), Decimal(rnd.randint(0, 1299)).scaleb(-2)) for _ in range(1_200)
    ]
    rows["customer"] = [
        (i, rnd.choice([*range(1, 41), None]), rnd.choice([0, 1, 1, None, 2])) for i in range(1, customers + 1)
    ]
    return rows


SQL = {
    "films_per_category": """
        SELECT name, COUNT(*) AS row_count, COUNT(DISTINCT film_id) AS film_count
        FROM film_category JOIN category USING (category_id) GROUP BY name
    """,
    "busiest_actors": """
        SELECT first_name || ' ' || COALESCE(last_name, '') AS actor_name, COUNT(rental_id) AS rental_count
        FROM film_actor JOIN film USING (film_id) JOIN inventory USING (film_id) JOIN rental USING (inventory_id)
             JOIN actor USING (actor_id)
        GROUP BY actor_id, first_name, last_name ORDER BY rental_count DESC, actor_id LIMIT 10
    """,
    "takings_per_category": """
        SELECT name, SUM(amount) AS amount
        FROM payment JOIN rental USING (rental_id) JOIN inventory USING (inventory_id) JOIN film USING (film_id)
             JOIN film_category USING (film_id) JOIN category USING (category_id)
        GROUP BY name
    """,
    "films_without_copy": """
        SELECT title FROM film ANTI JOIN inventory USING (film_id)
    """,
    "top_actors_in_category": """
        SELECT actor_name FROM (
            SELECT first_name || ' ' || COALESCE(last_name, '') AS actor_name, RANK() OVER (ORDER BY COUNT(*) DESC) AS r
            FROM category JOIN film_category USING (category_id) JOIN film USING (film_id)
                 JOIN film_actor USING (film_id) JOIN actor USING (actor_id)
            WHERE name = 'Children' GROUP BY actor_id, first_name, last_name)
        WHERE r <= 3
    """,
    "customers_per_city": """
        SELECT city, COUNT(DISTINCT customer_id) FILTER (active = 1) AS active_customers,
               COUNT(DISTINCT customer_id) FILTER (active = 0 OR active IS NULL) AS inactive_customers
        FROM customer LEFT JOIN address USING (address_id) LEFT JOIN city USING (city_id) GROUP BY city
    """,
    "longest_rented_category": """
        WITH labels AS (
            SELECT city_id, 'city begins with "a"' AS bucket FROM city WHERE lower(city[1]) = 'a'
            UNION ALL SELECT city_id, 'city contains "-"' FROM city WHERE contains(city, '-')),
        sums AS (
            SELECT bucket, name,
                   SUM(trunc(epoch(return_date - rental_date) / 3600)) AS hours
            FROM rental JOIN customer USING (customer_id) JOIN address USING (address_id) JOIN labels USING (city_id)
                 JOIN inventory USING (inventory_id) JOIN film USING (film_id) JOIN film_category USING (film_id)
                 JOIN category USING (category_id)
            GROUP BY bucket, name)
        SELECT bucket, first(name ORDER BY hours DESC NULLS LAST, name) AS category_name FROM sums GROUP BY bucket
    """,
}


ARROW = {"INT": pa.int32(), "STRING": pa.string(), "TIMESTAMP_NTZ": pa.timestamp("us"), "DECIMAL(5": pa.decimal128(5, 2)}


def frames(spark, rows, root):
    """The tables as Parquet files, which give Spark their sizes."""
    out = {}
    for name, ddl in SCHEMAS.items():
        fields = [part.split() for part in ddl.replace(",2)", "").split(", ")]
        schema = pa.schema([(column, ARROW[kind]) for column, kind in fields])
        columns = zip(*rows[name]) if rows[name] else [()] * len(fields)
        path = str(root / f"{name}.parquet")
        pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema), path)
        out[name] = spark.read.schema(ddl).parquet(path)
    return out


@pytest.fixture(scope="module")
def rows():
    return make_rows(11)


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    return frames(spark, rows, tmp_path_factory.mktemp("film_rental"))


@pytest.fixture(scope="module")
def answer(rows):
    con = duckdb.connect()
    for name, ddl in SCHEMAS.items():
        con.execute(f"CREATE TABLE {name} ({ddl.replace('TIMESTAMP_NTZ', 'TIMESTAMP').replace('STRING', 'VARCHAR')})")
        con.executemany(f"INSERT INTO {name} VALUES ({','.join('?' * len(rows[name][0]))})", rows[name])
    return lambda name: con.execute(SQL[name]).fetchall()


def same(got, want):
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", sorted(SQL))
def test_questions(tables, answer, name):
    want = answer(name)
    assert want
    same(getattr(film_rental, name)(tables).collect(), want)


@pytest.mark.parametrize(
    "name", ["busiest_actors", "takings_per_category", "top_actors_in_category", "longest_rented_category"]
)
def test_same_answer_when_keys_are_split(tables, answer, name):
    same(getattr(film_rental, name)(tables, hot_rows=1).collect(), answer(name))


def test_top_category(tables, answer):
    best = max(answer("takings_per_category"), key=lambda row: row[1])
    same(film_rental.top_category_by_takings(tables).collect(), [best])


def test_order_of_sorted_answers(tables):
    counts = [r.film_count for r in film_rental.films_per_category(tables).collect()]
    assert counts == sorted(counts, reverse=True)
    inactive = [r.inactive_customers for r in film_rental.customers_per_city(tables).collect()]
    assert inactive == sorted(inactive, reverse=True)
    busiest = [r.rental_count for r in film_rental.busiest_actors(tables).collect()]
    assert busiest == sorted(busiest, reverse=True) and len(busiest) == 10


def test_city_in_both_buckets(tables):
    got = {tuple(r) for r in film_rental.city_buckets(tables).collect()}
    ids = {name: i for i, name in enumerate(CITIES, 1)}
    assert (ids["Ash-Sham"], film_rental.BEGINS_WITH_A) in got and (ids["Ash-Sham"], film_rental.CONTAINS_DASH) in got
    assert (ids["abha"], film_rental.BEGINS_WITH_A) in got and (ids["Oslo"], film_rental.BEGINS_WITH_A) not in got


def test_sql_text_over_views(spark, tables, answer):
    """A user's own SQL text runs on the registered tables."""
    register_views(tables)
    text = """
        SELECT title FROM film LEFT ANTI JOIN inventory ON inventory.film_id = film.film_id
    """
    same(spark.sql(text).collect(), answer("films_without_copy"))


def test_unknown_durations_only(spark, tmp_path):
    """A category whose rentals are all out has no hours and comes after one with hours."""
    rows = {name: [] for name in SCHEMAS}
    out = dt.datetime(2005, 6, 1)
    rows["category"] = [(1, "A never back"), (2, "B back")]
    rows["film_category"] = [(1, 1), (2, 2)]
    rows["film"] = [(1, "x"), (2, "y")]
    rows["inventory"] = [(1, 1), (2, 2)]
    rows["customer"], rows["address"], rows["city"] = [(1, 1, 1)], [(1, 1)], [(1, "Aa")]
    rows["rental"] = [(1, 1, 1, out, None), (2, 2, 1, out, out + dt.timedelta(hours=2))]
    got = film_rental.longest_rented_category(frames(spark, rows, tmp_path)).collect()
    assert [tuple(r) for r in got] == [(film_rental.BEGINS_WITH_A, "B back")]
    rows["rental"] = rows["rental"][:1]
    got = film_rental.longest_rented_category(frames(spark, rows, tmp_path)).collect()
    assert [tuple(r) for r in got] == [(film_rental.BEGINS_WITH_A, "A never back")]
