"""Operators on hand-made rows, and against brute force."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.money import total, total_of_doubles
from tallyhouse.functions.text import begins_with_any_case, full_name, like_literal
from tallyhouse.functions.time import elapsed_hours, within_day
from tallyhouse.operators.buckets import label_buckets
from tallyhouse.operators.counting import distinct_where, rows_and_distinct, table_sizes
from tallyhouse.operators.joining import salted_join, without_match
from tallyhouse.operators.profile import numeric_profile
from tallyhouse.operators.ranking import first_in_group, top_k, top_k_with_ties


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_full_name_with_missing_parts(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee"), ("Ann", None), (None, None)], "a STRING, b STRING")
    assert rows_of(df.select(full_name(F.col("a"), F.col("b")))) == [("Ann Lee",), (" Lee",), ("Ann ",), (" ",)]


@pytest.mark.parametrize(
    ("minutes", "hours"), [(71 * 60 + 15, 71), (59, 0), (-(72 * 60 + 45), -72), (-59, 0), (25 * 60, 25), (0, 0)]
)
def test_elapsed_hours(spark, minutes, hours):
    start = dt.datetime(2024, 2, 28, 22, 59)
    df = spark.createDataFrame([(start, start + dt.timedelta(minutes=minutes))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert rows_of(df.select(elapsed_hours(F.col("a"), F.col("b")))) == [(hours,)]


def test_elapsed_hours_unknown(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), None)], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert rows_of(df.select(elapsed_hours(F.col("a"), F.col("b")))) == [(None,)]


def test_within_day(spark):
    moments = [dt.datetime(2024, 1, 14, 23, 59, 59, 999999), dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16)]
    df = spark.createDataFrame([(m,) for m in moments], "ts TIMESTAMP_NTZ")
    assert rows_of(df.filter(within_day(F.col("ts"), dt.date(2024, 1, 15)))) == [(moments[1],)]


def test_patterns_take_wildcards_literally(spark):
    df = spark.createDataFrame([("A_b",), ("Axb",), ("a_B",), ("50%",), ("500",), ("a\\b",)], "s STRING")
    assert rows_of(df.filter(begins_with_any_case(F.col("s"), "a_b"))) == [("A_b",), ("a_B",)]
    assert rows_of(df.filter(F.col("s").like(like_literal("50%")))) == [("50%",)]
    assert rows_of(df.filter(F.col("s").like(like_literal("a\\b")))) == [("a\\b",)]


def test_money_is_exact(spark):
    cents = [random.Random(5).randint(-10**9, 10**9) for _ in range(5_000)]
    df = spark.createDataFrame([(c / 100,) for c in cents], "x DOUBLE")
    got = df.agg(total_of_doubles(F.col("x")), total(F.col("x").cast("decimal(18,2)"))).first()
    assert got[0] == got[1] and int(got[0] * 100) == sum(cents)


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def either_mode(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_no_digit_of_a_decimal_is_dropped(spark, either_mode):
    four = spark.range(1000).selectExpr("CAST(0.0040 AS DECIMAL(18,4)) AS x")
    assert four.agg(total(F.col("x"))).first()[0] == Decimal("4.0000")
    large = spark.createDataFrame([(Decimal(10) ** 20,), (Decimal(1),), (None,)], "x DECIMAL(30,2)")
    assert large.agg(total(F.col("x"))).first()[0] == Decimal(10) ** 20 + 1


def test_money_that_cannot_be_summed_fails(spark, either_mode):
    too_large = spark.createDataFrame([(Decimal(9) * 10**37,)] * 3, "x DECIMAL(38,0)")
    for df, of in (
        (too_large, total),
        (spark.createDataFrame([(0.001,)], "x DOUBLE"), total_of_doubles),
        (spark.createDataFrame([(1e9 + 0.001,)], "x DOUBLE"), total_of_doubles),
        (spark.createDataFrame([(float("nan"),)], "x DOUBLE"), total_of_doubles),
        (spark.createDataFrame([(float("inf"),)], "x DOUBLE"), total_of_doubles),
        (spark.createDataFrame([(5e16,)] * 4, "x DOUBLE"), total_of_doubles),
    ):
        with pytest.raises(Exception, match="(?i)total exceeds|whole cents|overflow|out of range|cannot be represented"):
            df.agg(of(F.col("x"))).collect()


def test_money_of_nothing_and_of_rounded_cents(spark, either_mode):
    none = spark.createDataFrame([(None,)], "x DOUBLE")
    assert none.agg(total_of_doubles(F.col("x")), total(F.col("x").cast("decimal(9,2)"))).first()[:] == (None, None)
    near = spark.createDataFrame([(0.1 + 0.2,), (12.34 + 1,), (1e12 + 0.01,), (-0.07,)], "x DOUBLE")
    assert near.agg(total_of_doubles(F.col("x"))).first()[0] == Decimal("1000000000013.58")


def test_rows_and_distinct(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", None)], "g STRING, k INT")
    assert sorted(rows_of(rows_and_distinct(df, "g", "k", "n", "d"))) == [("x", 3, 2), ("y", 1, 0)]


def test_distinct_where_is_count_distinct_case(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["p", "q", None]), rnd.choice([1, 2, 3, 4, None]), rnd.choice([0, 1, 2, None])) for _ in range(200)]
    df = spark.createDataFrame(data, "g STRING, k INT, active INT")
    active = F.col("active")
    conditions = {"a": active == 1, "b": F.coalesce(active, F.lit(0)) == 0}
    want = df.groupBy("g").agg(*[F.countDistinct(F.when(c, F.col("k"))).alias(n) for n, c in conditions.items()])
    key = lambda row: str(row)
    assert sorted(rows_of(distinct_where(df, ["g"], "k", conditions)), key=key) == sorted(rows_of(want), key=key)


def test_table_sizes(spark):
    got = table_sizes({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(rows_of(got)) == [("a", 3), ("b", 0)]


def test_top_k_ties_go_by_key(spark):
    df = spark.createDataFrame([(4, 7), (1, 7), (3, 7), (2, 9), (5, None)], "id INT, n INT")
    assert rows_of(top_k(df, "n", 3, ["id"])) == [(2, 9), (1, 7), (3, 7)]


@pytest.mark.parametrize("k", [1, 2, 3, 10])
@pytest.mark.parametrize("seed", range(4))
def test_top_k_with_ties_is_rank(spark, k, seed):
    rnd = random.Random(seed)
    data = [(i, rnd.choice([1, 2, 3, None] if seed else [None, 4])) for i in range(rnd.choice([2, 12]))]
    df = spark.createDataFrame(data, "id INT, n INT").repartition(3)
    got = sorted(rows_of(top_k_with_ties(df, "n", k, "r")))
    order = [n for _, n in data]
    rank = {
        i: 1 + sum(1 for m in order if (n is None and m is not None) or (n is not None and m is not None and m > n))
        for i, n in data
    }
    assert got == sorted((i, n, rank[i]) for i, n in data if rank[i] <= k)


def test_top_k_with_ties_on_nothing(spark):
    assert rows_of(top_k_with_ties(spark.createDataFrame([], "id INT, n INT"), "n", 3, "r")) == []


def test_first_in_group(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "w"), ("b", None, "z")], "g STRING, n INT, t STRING")
    got = first_in_group(df, ["g"], [F.col("n").desc_nulls_last(), F.col("t").asc()])
    assert sorted(rows_of(got)) == [("a", 3, "w"), ("b", None, "z")]


@pytest.mark.parametrize("hot_rows", [1, 7, 10**6])
def test_salted_join_is_an_inner_join(spark, hot_rows):
    rnd = random.Random(3)
    many = [(1 if rnd.random() < 0.4 else rnd.choice([2, 3, 4, None]), i) for i in range(300)]
    few = [(1, "a"), (1, "b"), (2, "c"), (4, "d"), (5, "e"), (None, "f")]
    got = salted_join(
        spark.createDataFrame(many, "k INT, i INT"), spark.createDataFrame(few, "k INT, v STRING"), "k", "i", hot_rows
    )
    want = [(k, i, v) for k, i in many for key, v in few if k is not None and key == k]
    assert got.columns == ["k", "i", "v"]
    assert sorted(rows_of(got)) == sorted(want)


@pytest.mark.parametrize("hot_rows", [1, 7, 10**6])
def test_salted_join_with_a_known_bound(spark, hot_rows):
    rnd = random.Random(4)
    many = [(1 if rnd.random() < 0.4 else rnd.choice([2, 3, 4, None]), i) for i in range(300)]
    few = [(k, sum(key == k for key, _ in many) + 3 * (k % 2)) for k in (1, 2, 3, 5)] + [(None, 0)]
    got = salted_join(
        spark.createDataFrame(many, "k INT, i INT"), spark.createDataFrame(few, "k INT, n INT"), "k", "i", hot_rows, "n"
    )
    assert sorted(rows_of(got)) == sorted((k, i, n) for k, i in many for key, n in few if k is not None and key == k)


def test_salted_join_spreads_the_busy_key(spark):
    many = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    few = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(many, few, "k", "i", hot_rows=100)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 10_000 and len(sizes) > 4 and max(sizes) < 5_000


def test_without_match_keeps_null_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    right = spark.createDataFrame([(2,), (2,), (None,)], "k INT")
    assert sorted(rows_of(without_match(left, right, "k")), key=str) == [(1,), (None,)]


def test_label_buckets_may_overlap_and_repeat(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "ab"), (2, "b"), (3, "c")], "k INT, s STRING")
    got = label_buckets(df, "k", "l", {"has a": F.col("s").contains("a"), "has b": F.col("s").contains("b")})
    assert sorted(rows_of(got)) == [(1, "has a"), (1, "has b"), (2, "has b")]


def test_numeric_profile(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None), (5, 4.0)], "a INT, b DOUBLE")
    got = numeric_profile(df, ["a", "b"], 3)
    assert rows_of(got) == [("a", 3, 3.0, 2.0, 1.0, 5.0), ("b", 2, 3.0, 1.414, 2.0, 4.0)]
