"""Seven questions about a star of films, categories, people and rentals, by the role each table plays.

Every function takes DataFrames whose columns carry the role names below, so the same plans serve the
film-rental tables (``film_rental``) and any other star (``desk``).

    placed       film_id, category_id, name    films with their categories; a film may be in several
    film         film_id, title
    cast         film_id, actor_id             a film has many actors, an actor many films
    actor        actor_id, actor_name
    demand       film_id, rental_count         one row per film
    takings      film_id, amount               one row per film, decimal
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import total
from tallyhouse.operators.counting import distinct_where, rows_and_distinct
from tallyhouse.operators.joining import HOT_ROWS, salted_join, without_match
from tallyhouse.operators.ranking import first_in_group, top_k, top_k_with_ties


def films_per_category(placed: DataFrame) -> DataFrame:
    """Rows and distinct films per category name, largest first.

    Both counts are given: they differ once a film is placed in the same category twice.
    """
    return rows_and_distinct(placed, "name", "film_id", "row_count", "film_count").orderBy(
        F.col("film_count").desc_nulls_last(), "name"
    )


def busiest_actors(
    cast: DataFrame,
    actor: DataFrame,
    demand: DataFrame,
    k: int,
    hot_rows: int = HOT_ROWS,
    cast_within_rentals: bool = False,
) -> DataFrame:
    """The k actors whose films were rented most; people are told apart by id, ties go to the lower id.

    Rentals arrive already counted per film: joining the cast to every rental first would multiply the
    largest table by the size of each cast. ``cast_within_rentals`` says that no film has a larger cast than
    it has rentals, which saves counting the cast.
    """
    per_actor = (
        salted_join(
            cast, demand, "film_id", "actor_id", hot_rows, "rental_count" if cast_within_rentals else None
        )
        .groupBy("actor_id").agg(F.sum("rental_count").alias("rental_count"))
    )
    named = (
        per_actor.join(actor, "actor_id")
        .groupBy("actor_id", "actor_name").agg(F.sum("rental_count").alias("rental_count"))
    )
    return top_k(named, "rental_count", k, ["actor_id"])


def takings_per_category(
    placed: DataFrame, takings: DataFrame, one_category_each: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Money spent per category name. A film in several categories counts in each.

    ``one_category_each`` says that ``placed`` has one row per film, so that no film is a busy key.
    """
    if one_category_each:
        spent = placed.join(takings, "film_id")
    else:
        spent = salted_join(placed, takings, "film_id", "category_id", hot_rows)
    return spent.groupBy("name").agg(total(F.col("amount")).alias("amount"))


def films_without_copy(film: DataFrame, copies: DataFrame) -> DataFrame:
    """Films whose id occurs in no copy."""
    return without_match(film, copies, "film_id").select("film_id", "title")


def top_actors_in_category(appearances: DataFrame, actor: DataFrame, k: int) -> DataFrame:
    """Actors by number of appearances (rows with their actor_id), every tie up to rank k."""
    per_actor = appearances.groupBy("actor_id").agg(F.count("film_id").alias("appearances"))
    named = (
        per_actor.join(actor, "actor_id")
        .groupBy("actor_id", "actor_name").agg(F.sum("appearances").alias("appearances"))
    )
    return top_k_with_ties(named, "appearances", k, "actor_rank")


def active_and_inactive(members: DataFrame, group: str, key: str) -> DataFrame:
    """Distinct members per group with active = 1, and with active = 0 or unknown; most inactive first.

    Members without a group form a group of their own. Any other value of active counts on neither side.
    """
    active = F.col("active")
    counts = distinct_where(
        members,
        [group],
        key,
        {"active_count": active == 1, "inactive_count": F.coalesce(active, F.lit(0)) == 0},
    )
    return counts.orderBy(F.col("inactive_count").desc_nulls_last(), F.col(group).asc_nulls_last())


def longest_rented_per_bucket(hours: DataFrame) -> DataFrame:
    """Per bucket, the category name with the most hours; ``hours`` has bucket, name and hours.

    A sum of unknown durations only is null and comes last; ties go by name.
    """
    sums = hours.groupBy("bucket", "name").agg(F.sum("hours").alias("hours"))
    return first_in_group(sums, ["bucket"], [F.col("hours").desc_nulls_last(), F.col("name").asc_nulls_last()])
