"""Bronze, silver, checks and the incremental stream on small deliveries."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyhouse import workdir
from tallyhouse.lake import bronze, checks, silver
from tallyhouse.sources import schemas
from tallyhouse.sources.files import marked, read_csv, read_dated_dumps, read_dated_snapshots, read_json, read_json_split, unmarked
from tallyhouse.streaming.silver import refresh_silver

D1, D2, D3 = (dt.date(2021, 10, d) for d in (7, 8, 9))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def snapshot(path, records):
    put(path, json.dumps(records))


def record(product, day):
    return {"product_id": product, "date": str(day)}


def test_snapshot_array_on_one_line(spark, tmp_path):
    snapshot(tmp_path / "a.json", [record(7, D1), record(7, D1), record(None, D1), record(9, D1)])
    snapshot(tmp_path / "empty.json", [])
    got = read_json(spark, str(tmp_path), schemas.OUT_OF_STOCK)
    assert rows_of(got) == [(7, D1), (7, D1), (9, D1), (None, D1)]
    assert rows_of(silver.first_per_key(silver.clean(got, ["product_id", "date"]), ["product_id", "date"], [])) == [
        (7, D1), (9, D1),
    ]


def test_field_that_is_no_number_is_rejected(spark, tmp_path):
    put(tmp_path / "a.json", "\n".join(json.dumps(r) for r in [record(7, D1), record("seven", D1), {"date": "soon"}]))
    got = silver.clean(read_json(spark, str(tmp_path), schemas.OUT_OF_STOCK), ["product_id", "date"])
    assert rows_of(got) == [(7, D1)]


def test_csv_values_survive(spark, tmp_path):
    schema = "id INT, s STRING, ts TIMESTAMP_NTZ, at TIMESTAMP"
    moment = dt.datetime(2024, 1, 1, 2, 3, 4, 567891)
    texts = [
        "plain", "a,b", 'say "hi"', "two\nlines", "", None, "  padded  ", "back\\slash", "\\", "\\N", "\\\\N", "\\\\\\N", "\\N\n", "N",
    ]
    data = [(i, text, moment, moment) for i, text in enumerate(texts)]
    bronze.ingest_day(spark.createDataFrame(data, schema), str(tmp_path / "t"), D1, "csv")
    got = read_csv(spark, str(tmp_path / "t"), schemas.with_day(schema))
    assert rows_of(got) == sorted([(*row, D1) for row in data], key=str)


def test_json_values_survive(spark, tmp_path):
    schema = "id INT, s STRING, x DOUBLE, ts TIMESTAMP_NTZ, at TIMESTAMP"
    moment = dt.datetime(2024, 1, 1, 2, 3, 4, 567891)
    data = [(1, 'q"\n', 0.1, moment, moment), (2, "\\N", -1e300, None, None), (3, None, None, None, moment)]
    bronze.ingest_day(spark.createDataFrame(data, schema), str(tmp_path / "t"), D1, "json")
    got = read_json(spark, str(tmp_path / "t"), schemas.with_day(schema))
    assert rows_of(got) == sorted([(*row, D1) for row in data], key=str)


def test_hand_laid_dumps(spark, tmp_path):
    """The layout with the day in folders and file names, null unmarked."""
    put(tmp_path / "shop/2022/1/25/orders_2022_01_25.csv", 'id,note\n1,"a ""b"", c"\n2,\n')
    put(tmp_path / "shop/2022/1/26/orders_2022_01_26.csv", 'id,note\n3,"x\ny"\n')
    put(tmp_path / "shop/2022/1/26/old_orders_2022_01_26.csv", "id,note\n9,no\n")
    got = read_dated_dumps(spark, str(tmp_path / "shop"), "orders", "id INT, note STRING")
    assert rows_of(got) == [
        (1, 'a "b", c', dt.date(2022, 1, 25)), (2, None, dt.date(2022, 1, 25)), (3, "x\ny", dt.date(2022, 1, 26)),
    ]
    put(tmp_path / "big/lines_2022_01_25.csv", "id,note\n" + "".join(f"{i},text {i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32KB")
    try:
        large = read_dated_dumps(spark, str(tmp_path / "big"), "lines", "id INT, note STRING", multi_line=False)
        assert large.select(F.spark_partition_id()).distinct().count() > 3 and large.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    snapshot(tmp_path / "feed/2021/10/out_of_stock_2021_10_07.json", [record(7, D1), record(8, D1)])
    snapshot(tmp_path / "feed/2021/10/out_of_stock_2021_10_08.json", [record(7, D2)])
    got = read_dated_snapshots(spark, str(tmp_path / "feed"), "out_of_stock", schemas.OUT_OF_STOCK)
    assert rows_of(got) == [(7, D1, D1), (7, D2, D2), (8, D1, D1)]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_reload_replaces_one_day_only(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    schema = schemas.with_day("id INT")
    bronze.write_days(spark.createDataFrame([(1, D1), (2, D1), (3, D2)], schema), path, fmt)
    kept = sorted(os.listdir(f"{path}/load_date={D2}"))
    for _ in range(2):
        bronze.ingest_day(spark.createDataFrame([(8,), (9,)], "id INT"), path, D1, fmt)
        back = read_csv(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(path)
        assert rows_of(back) == [(3, D2), (8, D1), (9, D1)]
    assert sorted(os.listdir(f"{path}/load_date={D2}")) == kept


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_reload_without_rows_empties_the_day(spark, tmp_path, fmt):
    path, schema = str(tmp_path / fmt), schemas.with_day("id INT")
    bronze.write_days(spark.createDataFrame([(1, D1), (3, D2)], schema), path, fmt)
    bronze.ingest_day(spark.createDataFrame([], "id INT"), path, D1, fmt)
    back = read_csv(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(path)
    assert rows_of(back) == [(3, D2)]
    bronze.ingest_day(spark.createDataFrame([(4,)], "id INT"), path, D1, fmt)
    back = read_csv(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(path)
    assert rows_of(back) == [(3, D2), (4, D1)]


def test_one_day_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = schemas.with_day("id INT")
    bronze.write_days(spark.createDataFrame([(1, D1), (2, D2)], schema), path, "parquet")
    plan = spark.read.parquet(path).filter(F.col("load_date") == F.lit(D1))
    assert "PartitionFilters: [isnotnull(load_date" in plan._jdf.queryExecution().toString()
    assert rows_of(plan) == [(1, D1)]


def test_land_tables(spark, tmp_path):
    tables = {"a": spark.range(3), "b": spark.createDataFrame([("x",)], "s STRING")}
    bronze.land_tables(tables, str(tmp_path), "shop", D1)
    assert rows_of(read_csv(spark, f"{tmp_path}/shop/a", schemas.with_day("id BIGINT"))) == [(0, D1), (1, D1), (2, D1)]
    assert rows_of(read_csv(spark, f"{tmp_path}/shop/b", schemas.with_day("s STRING"))) == [("x", D1)]


def test_other_tables_land_when_one_fails(spark, tmp_path):
    def broken():
        raise OSError("no connection")

    bad_rows = spark.range(1).select(F.raise_error(F.lit("bad row")).cast("string").alias("s"))
    lists = spark.createDataFrame([([1.5, None],), (None,)], "v ARRAY<FLOAT>")
    with pytest.raises(bronze.LandingError, match="shop: not landed: a, b") as caught:
        bronze.land_tables({"a": broken, "b": bad_rows, "c": lists, "d": lambda: spark.range(2)}, str(tmp_path), "shop", D1)
    assert set(caught.value.failed) == {"a", "b"}
    assert read_json(spark, f"{tmp_path}/shop/c", schemas.with_day("v ARRAY<FLOAT>")).count() == 2
    assert read_csv(spark, f"{tmp_path}/shop/d", schemas.with_day("id BIGINT")).count() == 2


def test_a_listed_database_is_landed(spark, tmp_path, monkeypatch):
    tables = {"orders": spark.range(3), "aisles": spark.createDataFrame([("x",)], "s STRING")}
    catalog = spark.createDataFrame([(name,) for name in tables], "table_name STRING")
    monkeypatch.setattr(bronze.jdbc, "list_tables", lambda spark, db, schema: catalog)
    monkeypatch.setattr(bronze.jdbc, "read_table", lambda spark, db, name, key: tables[name])
    assert bronze.land_database(spark, None, str(tmp_path), "shop", D1) == {"aisles": "csv", "orders": "csv"}
    assert read_csv(spark, f"{tmp_path}/shop/orders", schemas.with_day("id BIGINT")).count() == 3
    asked = []
    monkeypatch.setattr(bronze.jdbc, "read_by_quantiles", lambda spark, db, name, key: asked.append((name, key)) or tables[name])
    bronze.land_database(spark, None, str(tmp_path), "shop", D2, keys={"orders": "id"}, by_quantiles=True)
    assert asked == [("orders", "id")] and read_csv(spark, f"{tmp_path}/shop/orders", schemas.with_day("id BIGINT")).count() == 6


def test_input_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(5, numPartitions=1).rdd.map(lambda r: (seen.add(1), r[0])[1:]).toDF("id BIGINT")
    bronze.ingest_day(rows, str(tmp_path / "t"), D1, "csv")
    assert seen.value == 5


def test_folders_are_removed_by_their_owner(spark, tmp_path):
    path = workdir.new_folder(spark, "x")
    spark.range(1).write.parquet(path)
    assert "x-" in path and workdir.folders_in(spark, os.path.dirname(path))
    assert workdir.clear(spark) >= 1 and not os.path.exists(path)
    assert workdir.folders_in(spark, str(tmp_path / "none")) == []


def test_a_large_day_is_divided(spark, tmp_path):
    """One day holds nearly all rows; its folder still gets several files, written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        days = spark.range(0, 60_000, 1, 8).select(
            "id", F.when(F.col("id") % 100 == 0, F.lit(D2)).otherwise(F.lit(D1)).alias("load_date")
        )
        bronze.write_days(days, str(tmp_path / "t"), "parquet")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: [f for f in os.listdir(tmp_path / "t" / f"load_date={d}") if f.endswith(".parquet")] for d in (D1, D2)}
    assert len(files[D1]) > 3 and len(files[D2]) <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_first_per_key_keeps_the_lowest_row(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, "x"), (1, "a", 3, "z"), (1, "a", 3, "y"), (2, "a", 1, None)], "u INT, t STRING, id INT, v STRING"
    )
    assert rows_of(silver.first_per_key(df.repartition(4), ["u", "t"], ["id"])) == [(1, "a", 3, "y"), (2, "a", 1, None)]


def test_known_values_come_before_null(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 3, None), (1, 3, "b"), (2, None, None)], "u INT, o INT, v STRING")
    assert rows_of(silver.first_per_key(df.repartition(3), ["u"], ["o"])) == [(1, 3, "b"), (2, None, None)]


def test_blank_required_texts_are_rejected(spark):
    df = spark.createDataFrame([(1, "  "), (1, ""), (2, " a ")], "u INT, t STRING")
    assert rows_of(silver.clean(df, ["u", "t"])) == [(2, "a")]


def test_audit_agrees_with_silver(spark):
    data = [(1, " a", D1), (1, "a", D1), (1, "  ", D1), (None, "a", D1), (2, "b", D2), (1, "a", None), (2, "", D2)]
    df = spark.createDataFrame(data, schemas.with_day("u INT, t STRING")).repartition(3)
    kept = silver.first_per_key(silver.clean(df, ["u", "t", "load_date"]), ["u", "t", "load_date"], [])
    per_day = {r["load_date"]: r["count"] for r in kept.groupBy("load_date").count().collect()}
    audit = {r["load_date"]: tuple(r)[1:] for r in checks.load_audit(df, ["u", "t"]).collect()}
    assert audit == {D1: (4, 1, 1, 2), D2: (2, 1, 0, 1), None: (1, 0, 0, 1)}
    assert all(audit[day][1] == per_day.get(day, 0) for day in audit)


def test_clean_trims_before_comparing(spark):
    df = spark.createDataFrame([(1, " a"), (1, "a "), (None, "a"), (2, None)], "u INT, t STRING")
    assert rows_of(silver.clean(df, ["u", "t"])) == [(1, "a"), (1, "a")]


def test_missing_days_and_gate(spark, caplog):
    df = spark.createDataFrame([(1, D1), (2, D3), (3, D3)], schemas.with_day("id INT"))
    assert rows_of(checks.missing_days(spark, df, "load_date", D1, D3)) == [(D2,)]
    checks.require_day(df, D1, "feed")
    with pytest.raises(checks.MissingLoadError, match="feed: no data for 2021-10-08"):
        checks.require_day(df, D2, "feed")
    assert "feed: no data for 2021-10-08" in caplog.text


def test_audit_adds_up(spark, caplog):
    data = [(1, "a", D1), (1, "a", D1), (1, "b", D1), (None, "a", D1), (None, "a", D1), (1, None, D1), (1, "a", D2), (None, None, D3)]
    df = spark.createDataFrame(data, schemas.with_day("u INT, t STRING")).repartition(3)
    audit = checks.load_audit(df, ["u", "t"])
    assert rows_of(audit) == [(D1, 6, 2, 1, 3), (D2, 1, 1, 0, 0), (D3, 1, 0, 0, 1)]
    caplog.set_level("INFO")
    checks.log_audit(audit, "feed")
    assert "feed 2021-10-07: in=6 distinct=2 duplicate=1 rejected=3" in caplog.text


def test_work_folder_needs_a_shared_place_on_a_cluster(spark):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, **conf):
            self.conf = Conf(conf)

    shared = Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://store/run/"})
    assert workdir.new_folder(shared, "x").startswith("hdfs://store/run/tallyhouse/x-")
    assert workdir.new_folder(shared, "x") != workdir.new_folder(shared, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workdir.new_folder(Session(**{"spark.master": "yarn"}), "x")


# --- The stream -------------------------------------------------------------------------------------

STOCK = schemas.with_day("product_id INT, store STRING, seen INT")


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)

    def land(self, *rows):
        bronze.write_days(self.spark.createDataFrame(list(rows), STOCK), f"{self.root}/bronze", "json", mode="append")

    def run(self, **options):
        refresh_silver(
            self.spark, f"{self.root}/bronze", STOCK, f"{self.root}/silver", f"{self.root}/progress",
            ["product_id", "store", "load_date"], ["seen"], **options,
        )

    def silver(self):
        back = self.spark.read.parquet(f"{self.root}/silver")
        return rows_of(back.select("product_id", "store", "seen", "load_date"))

    def batch(self):
        return rows_of(
            silver.first_per_key(
                silver.clean(read_json(self.spark, f"{self.root}/bronze", STOCK), ["product_id", "store", "load_date"]),
                ["product_id", "store", "load_date"], ["seen"],
            ).select("product_id", "store", "seen", "load_date")
        )


def test_stream_dedupes_across_runs_and_takes_late_files(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land((1, "a", 5, D2), (1, "a ", 6, D2), (None, "a", 1, D2), (2, "a", 1, D3))
    feed.run()
    assert feed.silver() == [(1, "a", 5, D2), (2, "a", 1, D3)]
    # A day older than all others arrives last, and an earlier row for a key that is already there.
    feed.land((1, "a", 4, D2), (7, "b", 1, D1))
    feed.run()
    assert feed.silver() == sorted([(1, "a", 4, D2), (2, "a", 1, D3), (7, "b", 1, D1)], key=str) == feed.batch()


def test_stream_without_new_files_changes_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land((1, "a", 5, D1))
    feed.run()
    files = sorted(str(p) for p in (tmp_path / "silver").rglob("*.parquet"))
    feed.run()
    assert sorted(str(p) for p in (tmp_path / "silver").rglob("*.parquet")) == files


def test_stream_touches_only_days_with_new_files(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land((1, "a", 5, D1), (1, "a", 5, D2))
    feed.run()
    first = sorted(os.listdir(tmp_path / "silver" / f"load_date={D1}"))
    feed.land((2, "a", 5, D2))
    feed.run()
    assert sorted(os.listdir(tmp_path / "silver" / f"load_date={D1}")) == first
    assert feed.silver() == feed.batch()


def test_stream_clears_a_day_replaced_by_unusable_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land((1, "a", 5, D1), (2, "a", 5, D2))
    feed.run()
    feed.land((None, "a", 5, D2))
    feed.run()
    assert feed.silver() == [(1, "a", 5, D1), (2, "a", 5, D2)]
    unusable = spark.createDataFrame([(None, "a", 5)], "product_id INT, store STRING, seen INT")
    bronze.ingest_day(unusable, f"{tmp_path}/bronze", D1, "json")
    feed.run()
    assert feed.silver() == [(2, "a", 5, D2)]
    feed.land((7, "a", 5, D1))
    feed.run()
    assert feed.silver() == [(2, "a", 5, D2), (7, "a", 5, D1)]


def test_an_emptied_day_leaves_silver(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    nothing = spark.createDataFrame([], "product_id INT, store STRING, seen INT")
    feed.land((1, "a", 5, D1), (2, "a", 5, D2))
    feed.run()
    bronze.ingest_day(nothing, f"{tmp_path}/bronze", D1, "json")
    feed.run()
    assert feed.silver() == [(2, "a", 5, D2)]
    feed.land((7, "a", 5, D1))
    feed.run()
    assert feed.silver() == [(2, "a", 5, D2), (7, "a", 5, D1)] == feed.batch()
    for day in (D1, D2):
        bronze.ingest_day(nothing, f"{tmp_path}/bronze", day, "json")
    feed.run()
    assert feed.silver() == []


def test_each_touched_day_is_rebuilt_once_a_call(spark, tmp_path, monkeypatch):
    from tallyhouse.streaming import silver as stream

    feed, calls = Feed(spark, tmp_path), []
    plain = stream.bronze_to_silver
    monkeypatch.setattr(stream, "bronze_to_silver", lambda *args, **more: calls.append(1) or plain(*args, **more))
    for i in range(5):
        feed.land((i, "a", i, D1))
    feed.run(files_per_batch=1)
    assert len(calls) == 1 and feed.silver() == feed.batch() and len(feed.silver()) == 5


def test_days_noted_before_a_failure_are_rebuilt_later(spark, tmp_path, monkeypatch):
    from tallyhouse.streaming import silver as stream

    feed = Feed(spark, tmp_path)
    feed.land((1, "a", 5, D1))
    with monkeypatch.context() as patch:
        patch.setattr(stream, "bronze_to_silver", lambda *args, **more: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feed.run()
    feed.run()
    assert feed.silver() == [(1, "a", 5, D1)]


def test_stream_in_small_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for i in range(4):
        feed.land(*[(p, "a", p * i % 3, d) for p in range(6) for d in (D1, D2)])
    feed.run(files_per_batch=1)
    assert len(feed.silver()) == 12 and feed.silver() == feed.batch()


def test_table_dumps_reach_silver(spark, tmp_path):
    """Two days of a table's full dump; the second dump is delivered twice."""
    schema = "id INT, note STRING"
    first = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (2, ""), (None, "x")], schema)
    second = spark.createDataFrame([(1, "new"), (3, None)], schema)

    def job(df, day):
        bronze.land_tables({"t": df}, str(tmp_path / "bronze"), "shop", day)
        refresh_silver(
            spark, str(tmp_path / "bronze/shop/t"), schemas.with_day(schema), str(tmp_path / "silver"),
            str(tmp_path / "progress"), ["id", "load_date"], ["note"], fmt="csv",
        )

    for df, day in ((first, D1), (second, D2), (second, D2)):
        job(df, day)
    assert rows_of(spark.read.parquet(str(tmp_path / "silver")).select("id", "note", "load_date")) == [
        (1, "a\nb", D1), (1, "new", D2), (2, "", D1), (3, None, D2),
    ]


def test_daily_job(spark, tmp_path):
    """Delivered file -> gate -> bronze -> silver, day by day, with a rerun and a day without data."""
    bronze_path, schema = str(tmp_path / "bronze"), schemas.with_day(schemas.OUT_OF_STOCK)

    def job(day, records):
        delivered = tmp_path / f"in/{day}.json"
        snapshot(delivered, records)
        rows = read_json(spark, str(delivered), schemas.OUT_OF_STOCK)
        checks.require_day(rows, day, "out_of_stock", day="date")
        bronze.ingest_day(rows, bronze_path, day, "json")
        refresh_silver(
            spark, bronze_path, schema, str(tmp_path / "silver"), str(tmp_path / "progress"),
            ["product_id", "load_date"], ["date"],
        )
        return rows_of(spark.read.parquet(str(tmp_path / "silver")).select("product_id", "load_date"))

    assert job(D1, [record(p, D1) for p in (5, 7, 5, 7, 9)]) == [(5, D1), (7, D1), (9, D1)]
    assert job(D2, [record(5, D2), record(None, D2)]) == [(5, D1), (5, D2), (7, D1), (9, D1)]
    with pytest.raises(checks.MissingLoadError, match="2021-10-09"):
        job(D3, [])
    # The first day is delivered again, corrected; nothing of its first load remains.
    assert job(D1, [record(7, D1), record(8, D1)]) == [(5, D2), (7, D1), (8, D1)]


# --- Landing at once, files by bytes, counts of the write ---------------------------------------------


def test_tables_land_at_the_same_time(spark, tmp_path):
    """Each of two tables waits, in its task, until the other one has begun."""
    root = str(tmp_path)

    def meeting(me, other):
        def wait(rows):
            import time
            from pathlib import Path

            Path(root, me).touch()
            until = time.time() + 60
            while not Path(root, other).exists():
                assert time.time() < until, "the other table did not begin"
                time.sleep(0.05)
            yield from rows

        return spark.range(2, numPartitions=1).mapInPandas(wait, "id BIGINT")

    tables = {"a": meeting("a", "b"), "b": meeting("b", "a")}
    assert bronze.land_tables(tables, f"{root}/bronze", "shop", D1, at_once=2) == {"a": "csv", "b": "csv"}
    assert [read_csv(spark, f"{root}/bronze/shop/{t}", schemas.with_day("id BIGINT")).count() for t in tables] == [2, 2]


def test_properties_of_the_caller_hold_while_landing(spark, tmp_path):
    group = []

    def opened():
        group.append((spark.sparkContext.getLocalProperty("spark.jobGroup.id"), spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
        return spark.range(1)

    spark.sparkContext.setJobGroup("nightly", "all tables")
    try:
        bronze.land_tables({"a": opened, "b": opened}, str(tmp_path), "shop", D1, at_once=1)
        assert [g for g, _ in group] == ["nightly", "nightly"]
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_texts_land_in_files_near_the_target_size(spark, tmp_path):
    """48 texts of 1 MB that do not compress, and many short ones: no file holds much more than 4 MB, and several tasks read."""
    long = F.concat(*[F.sha2(F.concat("id", F.lit(str(i))), 256) for i in range(4)])
    rows = spark.range(0, 48, 1, 1).withColumn("s", F.expr("aggregate(sequence(1, 4096), '', (a, i) -> concat(a, sha2(concat(id, '-', i), 256)))"))
    short = spark.range(1000, 21_000, 1, 2).withColumn("s", F.substring(long, 1, 40))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4MB")
    try:
        bronze.ingest_day(rows.unionByName(short), str(tmp_path / "t"), D1, "csv")
    finally:
        spark.conf.set(size, before)
    sizes = [os.path.getsize(f) for f in (tmp_path / "t").rglob("*.csv")]
    assert sum(sizes) > 12_000_000 and len(sizes) >= 4 and max(sizes) <= 10_000_000
    back = read_csv(spark, str(tmp_path / "t"), schemas.with_day("id BIGINT, s STRING"))
    assert back.rdd.getNumPartitions() >= 3
    want = rows.unionByName(short).select("id", F.sha2("s", 256))
    assert rows_of(back.select("id", F.sha2("s", 256))) == rows_of(want)


def test_rows_are_dealt_by_their_values(spark, tmp_path, capsys):
    """No task sorts what it has read before it deals its rows out, whatever the columns are called."""
    rows = spark.range(0, 3000, 1, 3).selectExpr("id", "cast(id % 7 as string) as `a.b c`", "if(id % 2 = 0, null, '\\\\\\\\N') as s")
    day = rows.withColumn("load_date", F.lit(D1).cast("date"))
    bronze.dealt_by_values(day).explain()
    plan = capsys.readouterr().out
    assert "RoundRobin" not in plan and "hashpartitioning(id" in plan and "REBALANCE_PARTITIONS_BY_COL" in plan
    assert "load_date" not in plan.split("hashpartitioning(")[1].split("REBALANCE")[0]
    bronze.ingest_day(rows, str(tmp_path / "t"), D1, "csv")
    back = read_csv(spark, str(tmp_path / "t"), schemas.with_day("id BIGINT, `a.b c` STRING, s STRING"))
    assert rows_of(back) == rows_of(day)
    # A table of its day alone, and one whose rows are all alike.
    bronze.ingest_day(spark.range(50).selectExpr("'x' as s"), str(tmp_path / "same"), D1, "csv")
    assert rows_of(read_csv(spark, str(tmp_path / "same"), schemas.with_day("s STRING"))) == [("x", D1)] * 50
    assert bronze.dealt_by_values(day.select("load_date")).count() == 3000


@pytest.mark.parametrize("change", [marked, unmarked])
def test_no_pattern_is_laid_over_texts_that_do_not_end_like_the_null_mark(spark, change, capsys):
    texts = ["\\N", "\\\\N", "\\\\\\N", "N", "x\\N", "\\N\n", "\\n", "", None, "\\", "\n\\N"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, s STRING")
    bare = {marked: lambda t: "\\" + t, unmarked: lambda t: t[1:]}[change]
    least = {marked: 1, unmarked: 2}[change]
    want = [bare(t) if t and t.rstrip("N") == "\\" * (len(t) - 1) and len(t) > least and t[-1] == "N" else t for t in texts]
    assert [r["s"] for r in change(df).orderBy("i").collect()] == want
    change(df).explain()
    assert "EndsWith" in capsys.readouterr().out


def test_counts_of_the_write_equal_the_audit(spark, tmp_path):
    data = [
        (1, " a", D1), (1, "a", D1), (1, "b", D1), (None, "a", D1), (1, "  ", D1), (1, "a", D2), (2, "", D3), (1, "a", None), (3, None, None),
    ]
    df = spark.createDataFrame(data, schemas.with_day("u INT, t STRING")).repartition(3)
    counts = silver.bronze_to_silver(df, str(tmp_path / "silver"), ["u", "t", "load_date"], [])
    audit = {r["load_date"]: silver.DayCounts(*list(r)[1:]) for r in checks.load_audit(df, ["u", "t"]).collect()}
    assert counts == audit and counts[D1] == silver.DayCounts(5, 2, 1, 2) and counts[None] == silver.DayCounts(2, 0, 0, 2)


def test_counts_of_nothing_and_of_many_days(spark, tmp_path, monkeypatch):
    schema = schemas.with_day("u INT")
    assert silver.bronze_to_silver(spark.createDataFrame([], schema), str(tmp_path / "none"), ["u", "load_date"], []) == {}
    days = [dt.date(1969, 12, 20) + dt.timedelta(days=i) for i in range(40)]
    df = spark.createDataFrame([(i % 3, day) for day in days for i in range(5)], schema).repartition(5)
    assert silver.bronze_to_silver(df, str(tmp_path / "many"), ["u", "load_date"], []) == {d: silver.DayCounts(5, 3, 2, 0) for d in days}
    monkeypatch.setattr(silver, "COUNTED_DAYS", 41)
    assert len(silver.bronze_to_silver(df, str(tmp_path / "just"), ["u", "load_date"], [])) == 40
    monkeypatch.setattr(silver, "COUNTED_DAYS", 30)
    assert silver.bronze_to_silver(df, str(tmp_path / "too-many"), ["u", "load_date"], []) == {}


def test_many_days_are_rebuilt_in_several_writes(spark, tmp_path, monkeypatch):
    from tallyhouse.streaming import silver as stream

    monkeypatch.setattr(stream, "COUNTED_DAYS", 3)
    feed = Feed(spark, tmp_path)
    feed.land(*[(p, "a", 1, d) for p in range(3) for d in (D1, D2, D3)], (None, "a", 1, dt.date(2021, 10, 10)))
    feed.run()
    assert feed.silver() == feed.batch() and len(feed.silver()) == 9


def test_refresh_tells_what_it_did(spark, tmp_path, caplog):
    feed = Feed(spark, tmp_path)
    feed.land((1, "a", 5, D1), (1, "a ", 6, D1), (None, "a", 1, D1), (None, "a", 1, D2))
    caplog.set_level("INFO")
    counts = refresh_silver(
        spark, f"{tmp_path}/bronze", STOCK, f"{tmp_path}/silver", f"{tmp_path}/progress", ["product_id", "store", "load_date"], ["seen"]
    )
    assert counts == {D1: silver.DayCounts(3, 1, 1, 1), D2: silver.DayCounts(1, 0, 0, 1)}
    checks.log_counts(counts, "stock")
    assert "stock 2021-10-07: in=3 distinct=1 duplicate=1 rejected=1" in caplog.text


def test_a_day_cleared_after_it_was_noted_is_emptied(spark, tmp_path, monkeypatch):
    """A call fails after noting a day with sound rows, and the day is cleared before the next call."""
    from tallyhouse.streaming import silver as stream

    feed = Feed(spark, tmp_path)
    nothing = spark.createDataFrame([], "product_id INT, store STRING, seen INT")
    feed.land((1, "a", 5, D1), (2, "a", 5, D2))
    feed.run()
    feed.land((9, "a", 5, D1))
    with monkeypatch.context() as patch:
        patch.setattr(stream, "bronze_to_silver", lambda *args, **more: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feed.run()
    bronze.ingest_day(nothing, f"{tmp_path}/bronze", D1, "json")
    feed.run()
    assert feed.silver() == [(2, "a", 5, D2)] == feed.batch()
    # Cleared first and loaded again: the rows count.
    feed.land((3, "a", 1, D1))
    feed.run()
    assert feed.silver() == [(2, "a", 5, D2), (3, "a", 1, D1)] == feed.batch()


# --- Snapshots on one line, by several tasks --------------------------------------------------------

ODD_RECORDS = [
    {"product_id": 1, "date": "2021-10-07"}, {"product_id": None, "date": None}, {}, {"date": "a, b", "product_id": 2},
    {"product_id": 3, "date": 'say \\"hi\\" \\\\'}, {"product_id": 4, "date": "[1, 2] \\u007d \n é 日本"}, {"product_id": "x", "date": "bad"},
    {"other": True, "product_id": 5}, {"product_id": 6, "date": "{ only opened {"},
]


@pytest.mark.parametrize("style", ["array", "spaced", "lines", "one by one", "with a mark"])
def test_split_reader_gives_the_rows_of_the_plain_one(spark, tmp_path, style):
    text = {
        "array": json.dumps(ODD_RECORDS, ensure_ascii=False),
        "spaced": json.dumps(ODD_RECORDS).replace("}, {", "} ,\t {"),
        "lines": "\n".join(json.dumps(r) for r in ODD_RECORDS) + "\n",
        "one by one": "\n".join(json.dumps([r]) for r in ODD_RECORDS),
        "with a mark": "\ufeff" + json.dumps(ODD_RECORDS),
    }[style]
    put(tmp_path / "in/a.json", text)
    snapshot(tmp_path / "in/empty.json", [])
    put(tmp_path / "in/nothing.json", "")
    schema = "product_id INT, date STRING"
    plain = tmp_path / "plain/a.json"
    snapshot(plain, ODD_RECORDS)
    assert rows_of(read_json_split(spark, str(tmp_path / "in"), schema)) == rows_of(read_json(spark, str(plain), schema))


def test_one_line_is_read_by_several_tasks(spark, tmp_path):
    records = [record(i, D1) | {"note": "x" * (i % 50)} for i in range(30_000)]
    snapshot(tmp_path / "a.json", records)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256KB")
    try:
        rows = read_json_split(spark, str(tmp_path), schemas.OUT_OF_STOCK)
        assert rows.rdd.getNumPartitions() >= 6
        assert rows_of(rows) == rows_of(read_json(spark, str(tmp_path), schemas.OUT_OF_STOCK))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("odd", [{"a": "x}"}, {"a": "{}", "b": 1}, {"a": {"b": 1}}, {"a": [1, 2]}, {"a": '"}{"'}])
def test_braces_in_values_are_refused(spark, tmp_path, odd):
    snapshot(tmp_path / "a.json", [record(1, D1), odd, record(2, D1)])
    with pytest.raises(Exception, match="not a whole flat record"):
        read_json_split(spark, str(tmp_path), schemas.OUT_OF_STOCK).collect()


def test_a_file_cut_short_is_refused(spark, tmp_path):
    put(tmp_path / "a.json", json.dumps([record(1, D1), record(2, D1)])[:-8])
    with pytest.raises(Exception, match="not a whole flat record"):
        read_json_split(spark, str(tmp_path), schemas.OUT_OF_STOCK).collect()


def test_dated_snapshots_are_split_too(spark, tmp_path):
    for day in (D1, D2):
        snapshot(tmp_path / f"2021/10/out_of_stock_{day:%Y_%m_%d}.json", [record(p, day) for p in range(5)])
    plain, split = (read_dated_snapshots(spark, str(tmp_path), "out_of_stock", schemas.OUT_OF_STOCK, split=s) for s in (False, True))
    assert rows_of(split) == rows_of(plain) and len(rows_of(plain)) == 10 and split.columns == plain.columns
