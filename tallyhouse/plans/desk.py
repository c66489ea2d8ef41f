"""Every operator on the order-desk tables (customers, orders, line items, events, documents).

One function per query; each takes a session and the folder with the tables. In the seven star questions
a part plays the film, its brand the category, a supplier the actor, and line items the rentals.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.money import total_of_doubles
from tallyhouse.functions.text import full_name, like_literal
from tallyhouse.functions.time import elapsed_hours, file_day, iso_day, within_day
from tallyhouse.lake import bronze, checks, silver
from tallyhouse.operators.buckets import label_buckets
from tallyhouse.operators.counting import table_sizes
from tallyhouse.operators.profile import numeric_profile
from tallyhouse.operators.ranking import top_k
from tallyhouse.plans import star
from tallyhouse.sources import schemas
from tallyhouse.sources.files import WRITE_OPTIONS, read_csv, read_json, read_json_split, read_table, read_tables
from tallyhouse.sources.views import register_views
from tallyhouse.streaming.silver import refresh_silver
from tallyhouse.workdir import new_folder

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
EVENT_KEYS = ("user_id", "event_type", "load_date")
FIRST_DAY = dt.date(2024, 1, 1)
LAST_EXPECTED_DAY = dt.date(2024, 2, 2)
RELOADED_DAY = dt.date(2024, 1, 15)


# --- The seven star questions -----------------------------------------------------------------------


def category_item_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per region, as rows and as distinct keys."""
    t = read_tables(spark, folder, ["customer", "nation", "region"])
    placed = (
        t["customer"].select(F.col("c_custkey").alias("film_id"), F.col("c_nationkey").alias("n_nationkey"))
        .join(t["nation"], "n_nationkey")
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnRenamed("r_name", "name")
    )
    return star.films_per_category(placed).select(
        F.col("name").alias("region_name"), "row_count", F.col("film_count").alias("customer_count")
    )


def _pairs(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("actor_id")).distinct()


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("actor_name")
    )


def top10_by_demand(spark: SparkSession, folder: str) -> DataFrame:
    """The ten suppliers whose parts were ordered most. Every supplier of a part has a line item for it."""
    lineitem = read_table(spark, folder, "lineitem")
    demand = lineitem.groupBy(F.col("l_partkey").alias("film_id")).agg(F.count("*").alias("rental_count"))
    top = star.busiest_actors(
        _pairs(lineitem), _suppliers(spark, folder), demand, 10, cast_within_rentals=True
    )
    return top.select(
        F.col("actor_id").alias("s_suppkey"), F.col("actor_name").alias("s_name"),
        F.col("rental_count").alias("demand"),
    )


def _brands(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(F.col("p_partkey").alias("film_id"), F.col("p_brand").alias("name"))


def _brand_revenue(spark: SparkSession, folder: str, sales: DataFrame) -> DataFrame:
    """Line items are summed per part before they meet the parts, which reduces a busy part in the map tasks."""
    takings = sales.groupBy(F.col("l_partkey").alias("film_id")).agg(
        total_of_doubles(F.col("l_extendedprice")).alias("amount")
    )
    return star.takings_per_category(_brands(spark, folder), takings, one_category_each=True)


def _as_revenue(amounts: DataFrame) -> DataFrame:
    return amounts.select(F.col("name").alias("p_brand"), F.col("amount").cast("double").alias("revenue"))


def revenue_by_category(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per brand, largest first, as SQL text over a view with the order given by position."""
    revenue = _brand_revenue(spark, folder, read_table(spark, folder, "lineitem"))
    view = f"brand_revenue_{uuid.uuid4().hex}"
    register_views({view: revenue})
    try:
        return spark.sql(
            f"SELECT name AS p_brand, CAST(amount AS DOUBLE) AS revenue FROM {view} ORDER BY 2 DESC NULLS LAST, 1"
        )
    finally:
        spark.catalog.dropTempView(view)  # the name is resolved by now


def top_category_by_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """The brand with most revenue among line items with an order of a known customer."""
    t = read_tables(spark, folder, ["lineitem", "orders", "customer"])
    orders = (
        t["orders"].select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
        .join(t["customer"].select("c_custkey"), "c_custkey")
        .select(F.col("o_orderkey").alias("l_orderkey"))
    )
    sales = t["lineitem"].select("l_orderkey", "l_partkey", "l_extendedprice").join(orders, "l_orderkey")
    return _as_revenue(top_k(_brand_revenue(spark, folder, sales), "amount", 1, ["name"]))


def items_without_stock(spark: SparkSession, folder: str) -> DataFrame:
    """Parts without a returned line item of 45 or more pieces."""
    t = read_tables(spark, folder, ["part", "lineitem"])
    film = t["part"].select(F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title"))
    copies = (
        t["lineitem"].filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45))
        .select(F.col("l_partkey").alias("film_id"))
    )
    return star.films_without_copy(film, copies).select(
        F.col("film_id").alias("p_partkey"), F.col("title").alias("p_name")
    )


def top3_in_category_with_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers by number of parts of one brand, all ties up to rank 3.

    Only whether a part is of the brand matters, so it is a semi join: where the brand's parts are few enough to be
    broadcast, Spark filters line items by them before the distinct, and the shuffle carries one brand. Otherwise pairs
    are made distinct first: by part and supplier, so a part that fills much of the table shrinks in the map tasks.
    """
    films = _brands(spark, folder).filter(F.col("name") == "Brand#7").select("film_id")
    appearances = _pairs(read_table(spark, folder, "lineitem")).join(films, "film_id", "left_semi")
    top = star.top_actors_in_category(appearances, _suppliers(spark, folder), 3)
    return top.select(
        F.col("actor_id").alias("s_suppkey"), F.col("actor_name").alias("s_name"),
        F.col("appearances").alias("part_count"), F.col("actor_rank").alias("supplier_rank"),
    )


def active_inactive_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """Documents per language labelled good, and labelled bad or not labelled at all.

    Both sides are reduced to what the counts need before the join: repeated ids on both sides would
    otherwise multiply.
    """
    t = read_tables(spark, folder, ["documents", "labels"])
    quality = t["labels"].select("doc_id", F.col("quality").alias("active")).distinct()
    members = t["documents"].select("doc_id", "lang").distinct().join(quality, "doc_id", "left")
    return star.active_and_inactive(members, "lang", "doc_id").select(
        "lang", F.col("active_count").alias("active_docs"), F.col("inactive_count").alias("inactive_docs")
    )


def _nation_buckets(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("n_name")
    return label_buckets(
        read_table(spark, folder, "nation"),
        "n_nationkey",
        "bucket",
        {"starts": name.ilike(like_literal("nation_1") + "%"), "ends": name.like("%1")},
    )


def bucket_membership(spark: SparkSession, folder: str) -> DataFrame:
    """Nations by name pattern; two of them carry both labels."""
    return _nation_buckets(spark, folder)


def bucket_top_category_by_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Per nation bucket, the brand with the most hours between order and shipment.

    A line item still open has no shipment yet and an unknown duration. Orders are cut down to bucket nations
    before they meet the line items; the labels are joined to sums per nation and brand. The joins
    in between are plain scans against scans, which adaptive execution can broadcast or split by size.
    """
    t = read_tables(spark, folder, ["customer", "orders", "lineitem"])
    buckets = _nation_buckets(spark, folder)
    customers = (
        t["customer"].select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
        .join(buckets, "n_nationkey", "left_semi")
    )
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate").join(customers, "o_custkey")
    returned = F.when(F.col("closed"), F.col("l_shipdate"))
    rentals = (
        t["lineitem"].select(
            F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_shipdate",
            (F.col("l_linestatus") == "F").alias("closed"),
        )
        .join(orders, "o_orderkey")
        .filter(F.col("l_shipdate") >= F.col("o_orderdate"))
        .select(
            F.col("l_partkey").alias("film_id"), "n_nationkey",
            elapsed_hours(F.col("o_orderdate"), returned).alias("hours"),
        )
    )
    per_nation = (
        rentals.join(_brands(spark, folder), "film_id")
        .groupBy("n_nationkey", "name").agg(F.sum("hours").alias("hours"))
    )
    return star.longest_rented_per_bucket(per_nation.join(buckets, "n_nationkey")).select(
        "bucket", F.col("name").alias("p_brand"), "hours"
    )


# --- Expressions ------------------------------------------------------------------------------------


def elapsed_hours_by_type(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    start = F.lit(FIRST_DAY).cast("timestamp_ntz")
    return events.groupBy("event_type").agg(F.sum(elapsed_hours(start, F.col("ts"))).alias("hours"))


def full_names(spark: SparkSession, folder: str) -> DataFrame:
    """Name and segment joined; the second form has a null part for one segment."""
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    partial = F.when(segment != "BUILDING", segment)
    return (
        read_table(spark, folder, "customer")
        .withColumn("full_name", full_name(name, segment))
        .withColumn("partial_name", full_name(name, partial))
        .select("c_custkey", "full_name", "partial_name")
    )


def like_vs_ilike(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    return read_table(spark, folder, "part").agg(
        F.count(F.when(name.like("R%"), 1)).alias("starts_same_case"),
        F.count(F.when(name.ilike("R%"), 1)).alias("starts_any_case"),
        F.count(F.when(name.like("%ge%"), 1)).alias("contains_same_case"),
        F.count(F.when(name.ilike("%GE%"), 1)).alias("contains_any_case"),
    )


def json_field_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events per value of ``k`` in their JSON text; text without a whole number there counts as null."""
    k = F.from_json("props", "k INT")["k"]
    return read_table(spark, folder, "events").groupBy(k.alias("k")).agg(F.count("*").alias("row_count"))


def json_records(spark: SparkSession, folder: str) -> DataFrame:
    """Customers encoded as JSON records and decoded again."""
    customer = read_table(spark, folder, "customer")
    return customer.select(F.to_json(F.struct("*")).alias("record")).select(
        "record", F.from_json("record", customer.schema).alias("decoded")
    ).select("record", "decoded.*")


def json_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as records on one line a file, and read back by as many tasks as the files have splits."""
    path = new_folder(spark, "snapshot-orders")
    orders = read_table(spark, folder, "orders")
    records = orders.select(F.to_json(F.struct("*"), {**WRITE_OPTIONS["json"], "ignoreNullFields": "false"}))
    records.write.option("lineSep", ", ").text(path)
    back = read_json_split(spark, path, orders.schema)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def profile_numeric(spark: SparkSession, folder: str) -> DataFrame:
    """Every numeric column of orders and of line items."""
    return numeric_profile(read_table(spark, folder, "orders")).unionByName(
        numeric_profile(read_table(spark, folder, "lineitem"))
    )


# --- Bronze and silver ------------------------------------------------------------------------------


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").withColumn("load_date", F.to_date("ts"))


def bronze_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "bronze-events-json")
    bronze.write_days(_events(spark, folder), path, "json")
    back = read_json(spark, path, schemas.with_day(schemas.TABLES["events"]))
    return back.withColumns(
        {"ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "load_date": iso_day(F.col("load_date"))}
    )


def bronze_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A full table landed as header CSV under one load date."""
    path = new_folder(spark, "bronze-customer-csv")
    bronze.ingest_day(read_table(spark, folder, "customer"), path, RELOADED_DAY, "csv")
    back = read_csv(spark, path, schemas.with_day(schemas.TABLES["customer"]))
    return back.withColumn("load_date", iso_day(F.col("load_date")))


def bronze_csv_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with quotes, line breaks and junk through header CSV."""
    path = new_folder(spark, "bronze-documents-csv")
    bronze.ingest_day(read_table(spark, folder, "documents"), path, RELOADED_DAY, "csv")
    return read_csv(spark, path, schemas.with_day(schemas.TABLES["documents"])).drop("load_date")


def landed_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every table of a source landed in full for a day; rows of each as read back."""
    root = new_folder(spark, "bronze-source")
    formats = bronze.land_tables(read_tables(spark, folder, TABLES), root, "desk", RELOADED_DAY)
    return table_sizes({name: _landed(spark, root, "desk", name, fmt) for name, fmt in formats.items()})


def _landed(spark: SparkSession, root: str, source: str, name: str, fmt: str) -> DataFrame:
    read = {"csv": read_csv, "json": read_json}[fmt]
    return read(spark, f"{root}/{source}/{name}", schemas.with_day(schemas.TABLES[name]))


def bronze_partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "bronze-events-days")
    bronze.write_days(_events(spark, folder), path, "json")
    day = F.col("load_date")
    counts = (
        read_json(spark, path, schemas.with_day(schemas.TABLES["events"])).groupBy(day).agg(F.count("*").alias("row_count"))
    )
    return counts.select(
        iso_day(day).alias("load_date"),
        file_day(day).alias("file_day"),
        F.year(day).alias("load_year"),
        F.month(day).alias("load_month"),
        F.dayofmonth(day).alias("load_day"),
        "row_count",
    )


def incremental_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """All days are loaded, then one day again with every value raised by one; the others stay as they were."""
    path = new_folder(spark, "bronze-events-reload")
    bronze.write_days(_events(spark, folder), path, "csv")
    reload = read_table(spark, folder, "events").filter(within_day(F.col("ts"), RELOADED_DAY))
    # Rounded, as the sum of a double and one need not be whole cents again.
    bronze.ingest_day(reload.withColumn("value", F.round(F.col("value") + 1, 2)), path, RELOADED_DAY, "csv")
    back = read_csv(spark, path, schemas.with_day(schemas.TABLES["events"]))
    return back.groupBy(iso_day(F.col("load_date")).alias("load_date")).agg(
        F.count("*").alias("row_count"), total_of_doubles(F.col("value")).cast("double").alias("value_sum")
    )


def silver_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned events, the first of each user, type and day, read back from the silver Parquet table."""
    path = new_folder(spark, "silver-events")
    silver.bronze_to_silver(_events(spark, folder), path, EVENT_KEYS, ["event_id"])
    return _silver_rows(spark, path)


def silver_from_dumps(spark: SparkSession, folder: str) -> DataFrame:
    """A table dump from bronze CSV to silver Parquet by the incremental step."""
    root = new_folder(spark, "dumps")
    bronze.land_tables({"customer": read_table(spark, folder, "customer")}, f"{root}/bronze", "desk", RELOADED_DAY)
    schema = schemas.with_day(schemas.TABLES["customer"])
    refresh_silver(
        spark, f"{root}/bronze/desk/customer", schema, f"{root}/silver",
        f"{root}/progress", ["c_custkey", "load_date"], ["c_name"], fmt="csv",
    )
    return spark.read.schema(schema).parquet(f"{root}/silver").withColumn("load_date", iso_day(F.col("load_date")))


def _silver_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.with_day(schemas.TABLES["events"])).parquet(path).select(
        "user_id", "event_type", iso_day(F.col("load_date")).alias("load_date"), "event_id", "value", "props"
    )


def stream_silver_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings, each followed by a run of the stream; the second delivers one day over again."""
    landing = new_folder(spark, "stream-bronze")
    table = new_folder(spark, "stream-silver")
    progress = new_folder(spark, "stream-progress")
    events = _events(spark, folder)
    again = events.filter(within_day(F.col("ts"), RELOADED_DAY))
    for delivery in (events, again):
        bronze.write_days(delivery, landing, "json", mode="append")
        refresh_silver(
            spark, landing, schemas.with_day(schemas.TABLES["events"]), table, progress, EVENT_KEYS, ["event_id"]
        )
    return _silver_rows(spark, table)


def silver_write_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What the write of events to silver counted on its way, a row per load date."""
    path = new_folder(spark, "silver-audited")
    counts = silver.bronze_to_silver(_events(spark, folder), path, EVENT_KEYS, ["event_id"])
    rows = [(day and day.isoformat(), n.rows_in, n.rows_distinct, n.rows_duplicate, n.rows_rejected) for day, n in counts.items()]
    return spark.createDataFrame(
        rows, "load_date STRING, rows_in BIGINT, rows_distinct BIGINT, rows_duplicate BIGINT, rows_rejected BIGINT"
    )


def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    audit = checks.load_audit(_events(spark, folder), ["user_id", "event_type"])
    return audit.withColumn("load_date", iso_day(F.col("load_date")))


def missing_load_days(spark: SparkSession, folder: str) -> DataFrame:
    start, end = (F.lit(d).cast("timestamp_ntz") for d in (FIRST_DAY, LAST_EXPECTED_DAY + dt.timedelta(days=1)))
    window = _events(spark, folder).filter((F.col("ts") >= start) & (F.col("ts") < end))
    gaps = checks.missing_days(spark, window, "load_date", FIRST_DAY, LAST_EXPECTED_DAY)
    return gaps.select(iso_day(F.col("load_date")).alias("load_date"))


def table_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return table_sizes(read_tables(spark, folder, TABLES))


def multi_source_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources, customers and suppliers, their whole tables landed by the same code, and their accounts as one."""
    root = new_folder(spark, "bronze-accounts")
    columns = {"customer": ("c_custkey", "c_name", "c_acctbal"), "supplier": ("s_suppkey", "s_name", "s_acctbal")}
    landed = []
    for source, names in columns.items():
        formats = bronze.land_tables({source: read_table(spark, folder, source)}, root, source, RELOADED_DAY)
        accounts = _landed(spark, root, source, source, formats[source]).select(*names).toDF("account", "name", "balance")
        landed.append(accounts.withColumn("source", F.lit(source)))
    return landed[0].unionByName(landed[1]).groupBy("source").agg(
        F.count("*").alias("row_count"), total_of_doubles(F.col("balance")).cast("double").alias("balance_sum")
    )
