"""The seven questions on the film-rental tables.

``tables`` maps category, film_category, film, film_actor, actor, inventory, rental, payment, customer,
address and city to DataFrames, from JDBC (``sources.jdbc.read_tables``) or from files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import total
from tallyhouse.functions.text import begins_with_any_case, full_name
from tallyhouse.functions.time import elapsed_hours
from tallyhouse.operators.buckets import label_buckets
from tallyhouse.operators.joining import HOT_ROWS, salted_join
from tallyhouse.operators.ranking import top_k
from tallyhouse.plans import star

Tables = Mapping[str, DataFrame]

# The labels under which cities are reported.
BEGINS_WITH_A = 'city begins with "a"'
CONTAINS_DASH = 'city contains "-"'

# Keys by which a database read of each table can be divided.
TABLE_KEYS = {
    "category": None,
    "film_category": "film_id",
    "film": "film_id",
    "film_actor": "film_id",
    "actor": "actor_id",
    "inventory": "inventory_id",
    "rental": "rental_id",
    "payment": "rental_id",
    "customer": "customer_id",
    "address": "address_id",
    "city": "city_id",
}


def _actors(t: Tables) -> DataFrame:
    return t["actor"].select("actor_id", full_name(F.col("first_name"), F.col("last_name")).alias("actor_name"))


def _film_ids(t: Tables) -> DataFrame:
    return t["film"].select("film_id")


def _placed(t: Tables) -> DataFrame:
    return t["film_category"].select("film_id", "category_id").join(
        t["category"].select("category_id", "name"), "category_id"
    )


def films_per_category(t: Tables) -> DataFrame:
    return star.films_per_category(_placed(t))


def busiest_actors(t: Tables, k: int = 10, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rentals are counted per copy, then per film: each join meets one row per key."""
    per_copy = t["rental"].groupBy("inventory_id").agg(F.count("rental_id").alias("n"))
    demand = (
        per_copy.join(t["inventory"].select("inventory_id", "film_id"), "inventory_id")
        .groupBy("film_id").agg(F.sum("n").alias("rental_count"))
        .join(_film_ids(t), "film_id")
    )
    cast = t["film_actor"].select("film_id", "actor_id")
    return star.busiest_actors(cast, _actors(t), demand, k, hot_rows).select("actor_name", "rental_count")


def takings_per_category(t: Tables, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Payments are summed per rental, then per copy, then per film."""
    per_rental = t["payment"].groupBy("rental_id").agg(total(F.col("amount")).alias("amount"))
    per_copy = (
        t["rental"].select("rental_id", "inventory_id").join(per_rental, "rental_id")
        .groupBy("inventory_id").agg(total(F.col("amount")).alias("amount"))
    )
    takings = (
        per_copy.join(t["inventory"].select("inventory_id", "film_id"), "inventory_id")
        .groupBy("film_id").agg(total(F.col("amount")).alias("amount"))
        .join(_film_ids(t), "film_id")
    )
    return star.takings_per_category(_placed(t), takings, hot_rows=hot_rows)


def top_category_by_takings(t: Tables) -> DataFrame:
    return top_k(takings_per_category(t), "amount", 1, ["name"])


def films_without_copy(t: Tables) -> DataFrame:
    return star.films_without_copy(t["film"], t["inventory"]).select("title")


def top_actors_in_category(
    t: Tables, name: str = "Children", k: int = 3, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Categories are joined on the film. (Film ids matched to category ids would keep one unrelated film.)"""
    films = _placed(t).filter(F.col("name") == name).select("film_id").join(_film_ids(t), "film_id")
    cast = t["film_actor"].select("film_id", "actor_id")
    appearances = salted_join(cast, films, "film_id", "actor_id", hot_rows)
    return star.top_actors_in_category(appearances, _actors(t), k).select("actor_name")


def customers_per_city(t: Tables) -> DataFrame:
    members = (
        t["customer"].select("customer_id", "address_id", "active")
        .join(t["address"].select("address_id", "city_id"), "address_id", "left")
        .join(t["city"].select("city_id", "city"), "city_id", "left")
    )
    return star.active_and_inactive(members, "city", "customer_id").select(
        "city", F.col("active_count").alias("active_customers"), F.col("inactive_count").alias("inactive_customers")
    )


def city_buckets(t: Tables) -> DataFrame:
    city = F.col("city")
    return label_buckets(
        t["city"],
        "city_id",
        "bucket",
        {BEGINS_WITH_A: begins_with_any_case(city, "a"), CONTAINS_DASH: city.contains("-")},
    )


def longest_rented_category(t: Tables, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rentals of customers in bucket cities only, summed per copy and city before they meet the films.

    The labels are joined after that sum, so a city with two labels repeats sums and not rentals; its
    hours count under both.
    """
    buckets = city_buckets(t)
    customers = (
        t["customer"].select("customer_id", "address_id")
        .join(t["address"].select("address_id", "city_id"), "address_id")
        .join(buckets, "city_id", "left_semi")
    )
    duration = elapsed_hours(F.col("rental_date"), F.col("return_date"))
    per_copy = (
        t["rental"].select("inventory_id", "customer_id", duration.alias("hours"))
        .join(customers, "customer_id")
        .groupBy("inventory_id", "city_id").agg(F.sum("hours").alias("hours"))
    )
    per_film = (
        per_copy.join(t["inventory"].select("inventory_id", "film_id"), "inventory_id")
        .join(buckets, "city_id")
        .groupBy("film_id", "bucket").agg(F.sum("hours").alias("hours"))
        .join(_film_ids(t), "film_id")
    )
    hours = salted_join(_placed(t), per_film, "film_id", "category_id", hot_rows)
    return star.longest_rented_per_bucket(hours).select(
        F.col("bucket").alias("city_name"), F.col("name").alias("category_name")
    )
