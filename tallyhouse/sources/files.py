"""File readers and the writer options that make their round trips whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tallyhouse.sources import schemas

# The default time formats keep milliseconds only. Readers need none: without a format they take
# microseconds and zones as they come.
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_TIMES = {"timestampNTZFormat": _MICROS, "timestampFormat": _MICROS + "XXX", "timeZone": "UTC"}
NULL_MARK = "\\N"
# A quote inside a value is doubled. Null has its own mark, because an unmarked null and an empty string
# are read back as the same thing.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "nullValue": NULL_MARK,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Values may hold line breaks, so a CSV file is read by one task: keep files bounded.
READ_OPTIONS = {
    "json": {},
    "csv": {**CSV_OPTIONS, "multiLine": "true", "enforceSchema": "false"},
    "parquet": {},
}
WRITE_OPTIONS = {
    "json": _TIMES,
    "csv": {**CSV_OPTIONS, **_TIMES, "emptyValue": '""'},
    "parquet": {},
}


def marked(df: DataFrame) -> DataFrame:
    """Texts that would read as the null mark get one backslash more: \\N, and those that look like it then.

    Nearly all texts end otherwise, and no pattern is laid over those.
    """
    return _each_text(df, lambda c: F.when(c.endswith(NULL_MARK) & c.rlike(r"^\\+N\z"), F.concat(F.lit("\\"), c)).otherwise(c))


def unmarked(df: DataFrame) -> DataFrame:
    """What ``marked`` changed, as it was."""
    return _each_text(df, lambda c: F.when(c.endswith(NULL_MARK) & c.rlike(r"^\\{2,}N\z"), F.substring(c, 2, 2**31 - 1)).otherwise(c))


def _each_text(df: DataFrame, change) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({name: change(F.col(f"`{name}`")) for name in texts}) if texts else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the desk. Its schema is given, so nothing is read before the query runs."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in names}


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines, or files holding one array of records on a single line.

    A field that does not parse becomes null; judge bad rows by null required fields.
    """
    return spark.read.schema(schema).options(**READ_OPTIONS["json"]).json(path)


def read_json_split(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """As ``read_json``, with several tasks to a file, even where it is one array on a single line. Records must be flat.

    The text is cut after every closing brace, wherever a split of the file begins. A piece that is not a whole record, because a
    brace stands inside a value or a record holds another, fails the query: such files are for ``read_json``. No row is
    read in part: pieces before the first odd one are whole records, and the odd one does not parse. Arrays, lines
    of records, and white space anywhere between them all read the same.
    """
    return _split_records(spark.read, path, schema).select("_record.*")


def _split_records(reader, path: str, schema: StructType | str) -> DataFrame:
    pieces = reader.option("lineSep", "}").text(path)
    # What stands between records, and nothing else, at the end of a file.
    piece = F.regexp_replace("value", r"^[\s,\[\]\x{FEFF}]+", "")
    record = F.concat(F.col("_piece"), F.lit("}"))
    # Without its strings a flat record holds no further brace, and a piece cut inside a string holds a quote.
    bare = F.regexp_replace(record, r'"(?:[^"\\]|\\.)*+"', "")
    whole = F.when(bare.rlike(r'^\{[^{}\[\]"]*\}$'), record).otherwise(
        F.raise_error(F.concat(F.lit("not a whole flat record, read this file with read_json: "), F.substring(F.col("_piece"), 1, 200)))
    )
    rows = pieces.select("*", "_metadata", piece.alias("_piece")).filter(F.col("_piece") != "")
    return rows.select(F.from_json(whole, schema).alias("_record"), F.col("_metadata.file_name").alias("_file"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, null_mark: str = NULL_MARK) -> DataFrame:
    """Header CSV, as the bronze layer writes it.

    Dumps made by a database's own CSV export leave null unmarked; pass ``null_mark=""`` for those. Only the bronze
    layer's own mark is known to be escaped in texts; with any other, texts are taken as they stand.
    """
    rows = spark.read.schema(schema).options(**READ_OPTIONS["csv"]).option("nullValue", null_mark).csv(path)
    return unmarked(rows) if null_mark == NULL_MARK else rows


def read_days(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, days: Iterable[dt.date]
) -> DataFrame:
    """Some days of a table laid out by ``load_date``; the folders of other days are not even listed."""
    folders = [f"{path.rstrip('/')}/load_date={day.isoformat()}" for day in days]
    reader = spark.read.schema(schema).options(**READ_OPTIONS[fmt]).option("basePath", path)
    rows = reader.format(fmt).load(folders)
    return unmarked(rows) if fmt == "csv" else rows


def read_dated_dumps(
    spark: SparkSession, root: str, table: str, schema: StructType | str, multi_line: bool = True
) -> DataFrame:
    """Hand-laid dumps ``root/<year>/<month>/<day>/<table>_<year>_<month>_<day>.csv`` with their day.

    The day comes from the file name, whatever the depth of the folders above it. A dump is one file, and with
    ``multi_line`` one task reads it, because a line break may stand inside a value. Where no value holds one, pass
    ``multi_line=False``: a file of any size is then read by as many tasks as it has splits.
    """
    dumps = (
        spark.read.schema(schema)
        .options(**READ_OPTIONS["csv"])
        .option("nullValue", "")
        .option("multiLine", str(multi_line).lower())
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"{table}_[0-9][0-9][0-9][0-9]_[0-9][0-9]_[0-9][0-9].csv")
        .csv(root)
    )
    return dumps.withColumn("load_date", _day_in_name())


def read_dated_snapshots(
    spark: SparkSession, root: str, name: str, schema: StructType | str, split: bool = False
) -> DataFrame:
    """Hand-laid snapshots ``root/<year>/<month>/<name>_<year>_<month>_<day>.json`` with their day.

    A snapshot on one line is read by one task; ``split`` divides it, as ``read_json_split`` does, if its records are flat.
    """
    files = f"{name}_[0-9][0-9][0-9][0-9]_[0-9][0-9]_[0-9][0-9].json"
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", files)
    if split:
        return _split_records(reader, root, schema).select("_record.*", _day_in(F.col("_file")).alias("load_date"))
    snapshots = reader.schema(schema).options(**READ_OPTIONS["json"]).json(root)
    return snapshots.withColumn("load_date", _day_in_name())


def _day_in_name():
    return _day_in(F.col("_metadata.file_name"))


def _day_in(file):
    day = F.regexp_extract(file, r"_(\d{4}_\d{2}_\d{2})\.\w+$", 1)
    return F.to_date(day, "yyyy_MM_dd")
