"""Secret scans over an incremental ledger of blobs; DataFrame operations only.

Every version of every path is addressed by its content. The ledger holds which (blob, rule, rule version) have been
scanned and what was found. A scan reads the text of one path for each blob that lacks a rule, whatever the number
of paths and versions that share it, and findings are joined back to all of them by address.

Positions come from the text between matches: the pieces that a split by the pattern leaves and the matches
themselves alternate, so a match starts where the lengths before it end. Lengths are in code points.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import free_name, key_text, read, staged
from tallyhouse.workdir import new_folder


@dataclass(frozen=True)
class Rule:
    """Matches are found by ``pattern`` alone; those whose ``measured`` group is shorter than ``least`` are dropped.

    A text that lacks ``needed`` cannot have a match that is kept. Change ``version`` with any other field.
    """

    name: str
    pattern: str
    measured: int
    least: int
    needed: str
    version: int = 1


# The three kinds in their order. A run of hex digits, and of what follows AKIA, is one match or none at any
# length, so the least lengths can stand in the patterns: short runs, which texts are full of, are no matches to be dropped.
RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    ),
    Rule("access", "AKIA[A-Z0-9]{16,}", 0, 20, "AKIA[A-Z0-9]{16}"),
    Rule("hex", "[0-9a-f]{24,}", 0, 24, "[0-9a-f]{24}"),
)
SCANNED = "blob string, rule string, version int"
FINDINGS = "blob string, rule string, version int, start long, end long"
MASK = "[secret]"


def blob_of(text: Column) -> Column:
    """The address of a content; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _lengths(rule: Rule, text: Column) -> Column:
    """array<struct<before, own, measured>>: lengths of the piece before each match, of the match and of its group."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    parts = F.split(text, rule.pattern, -1)
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.measured)) if rule.measured else hits
    each = F.transform(
        F.arrays_zip(F.slice(parts, F.lit(1), F.size(hits)).alias("p"), hits.alias("h"), measured.alias("m")),
        lambda x: F.struct(
            F.length(x["p"]).alias("before"), F.length(x["h"]).alias("own"), F.length(x["m"]).alias("measured")
        ),
    )
    return F.when(text.rlike(rule.needed), each)


class Ledger:
    """Findings by content under a folder that all executors share. ``scan`` may be called again and again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        for table, schema in (("scanned", SCANNED), ("findings", FINDINGS)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{table}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(SCANNED).parquet(f"{self.path}/scanned").distinct()

    def findings(self) -> DataFrame:
        return self.spark.read.schema(FINDINGS).parquet(f"{self.path}/findings").distinct()

    def scan(self, versions: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
        """Scans what the ledger lacks of ``versions`` (path: any type, text) and returns (path, blob), one per row.

        A scan that fails leaves no (blob, rule, version) marked that has no findings written: findings go first,
        and findings written twice count once.
        """
        address = staged(versions.select("path", blob_of(F.col("text")).alias("blob")), "versions")
        wanted = address.groupBy("blob").agg(F.min(key_text(F.col("path"))).alias("path_key"))
        done = self.scanned().select("blob", F.concat_ws("@", "rule", "version").alias("id"))
        done = done.groupBy("blob").agg(F.collect_set("id").alias("done"))  # bounded by the rules
        ids = F.array(*[F.lit(f"{rule.name}@{rule.version}") for rule in rules])
        lacking = F.array_except(ids, F.coalesce("done", F.array().cast("array<string>")))
        wanted = wanted.join(done, "blob", "left").select("blob", "path_key", lacking.alias("lacking"))
        unseen = staged(wanted.filter(F.size("lacking") > 0), "unseen-blobs")
        texts = versions.select(
            blob_of(F.col("text")).alias("blob"),
            key_text(F.col("path")).alias("path_key"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        # The text moves once, by an address that is unique but for repeated rows; only the short side is built.
        blobs = texts.join(unseen.hint("shuffle_hash"), ["blob", "path_key"])
        found = F.array(
            *[
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.lit(rule.version).alias("version"),
                    F.lit(rule.least).alias("least"),
                    F.when(F.array_contains("lacking", f"{rule.name}@{rule.version}"), _lengths(rule, F.col("text"))).alias(
                        "matches"
                    ),
                )
                for rule in rules
            ]
        )
        matches = (
            blobs.select("blob", F.inline(found))
            .filter(F.size("matches") > 0)
            .dropDuplicates(["blob", "rule", "version"])
            .select("blob", "rule", "version", "least", F.posexplode("matches").alias("place", "match"))
            .select("blob", "rule", "version", "least", "place", "match.*")
        )
        in_order = Window.partitionBy("blob", "rule", "version").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum(F.col("before") + F.col("own")).over(in_order)
        spans = matches.withColumn("end", end).filter(F.col("measured") >= F.col("least"))
        spans.select("blob", "rule", "version", (F.col("end") - F.col("own")).alias("start"), "end").write.mode(
            "append"
        ).parquet(f"{self.path}/findings")
        pairs = unseen.select("blob", F.explode("lacking").alias("id"))
        pairs.select(
            "blob",
            F.substring_index("id", "@", 1).alias("rule"),
            F.substring_index("id", "@", -1).cast("int").alias("version"),
        ).write.mode("append").parquet(f"{self.path}/scanned")
        return address

    def spans(self, rules: Sequence[Rule] = RULES) -> DataFrame:
        """(blob, spans array<struct<start, kind, end>> by start and order of kinds) of blobs with findings of ``rules``.

        The spans of a blob are bounded by its text.
        """
        wanted = reduce(
            Column.__or__, [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules]
        )
        kind = reduce(lambda rest, i: rest.when(F.col("rule") == rules[i].name, i), range(len(rules)), F)
        return (
            self.findings()
            .filter(wanted)
            .groupBy("blob")
            .agg(F.array_sort(F.collect_list(F.struct("start", kind.alias("kind"), "end"))).alias("spans"))
        )


def _named(spans: Column, rules: Sequence[Rule]) -> Column:
    names = F.array(*[F.lit(rule.name) for rule in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def scan_secrets(
    docs: DataFrame, ledger: Ledger | None = None, rules: Sequence[Rule] = RULES, path: str = "doc_id", text: str = "text"
) -> DataFrame:
    """path, blob and ``spans`` (array<struct<start, kind, end>>, empty where nothing was found) of every row of ``docs``.

    Null and empty texts have no findings. Repeated rows and copies give a row each, from one scan. Rows without a
    path are kept. Without a ledger a new one is made. Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, new_folder(spark, "ledger"))
    address = ledger.scan(docs.select(F.col(path).alias("path"), F.col(text).alias("text")), rules)
    found = staged(ledger.spans(rules), "blob-spans")
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return address.join(found, "blob", "left").select("path", "blob", F.coalesce("spans", nothing).alias("spans"))


def masked(docs: DataFrame, rules: Sequence[Rule] = RULES, mask: str = MASK) -> DataFrame:
    """``docs`` with every found secret replaced by ``mask`` in its text; n_chars, if there, counts the new text.

    Overlapping findings are masked as one. All rows and columns stay; a null text stays null.
    """
    spark = docs.sparkSession
    ledger = Ledger(spark, new_folder(spark, "ledger"))
    ledger.scan(docs.select(F.col("doc_id").alias("path"), "text"), rules)
    by_start = Window.partitionBy("blob").orderBy("start", "end")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True)).cast("int")
    island = F.sum("fresh").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        ledger.findings()
        .withColumn("fresh", fresh)
        .withColumn("island", island)
        .groupBy("blob", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    )
    cuts, blob = free_name(docs, "_cuts"), free_name(docs, "_blob")
    merged = staged(merged.select(F.col("blob").alias(blob), F.col("cuts").alias(cuts)), "blob-cuts")
    joined = docs.withColumn(blob, blob_of(F.col("text"))).join(merged, blob, "left")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    starts = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length("text").cast("long")))
    pieces = F.transform(
        F.arrays_zip(ends.alias("a"), starts.alias("b")),
        lambda x: F.substring(F.col("text"), (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")),
    )
    text = F.when(F.col(cuts).isNull(), F.col("text")).otherwise(F.array_join(pieces, mask))
    out = joined.withColumn("text", text).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(read(spark, folder, "documents").select("doc_id", "text"))
    named = _named(F.col("spans"), RULES)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("path").alias("doc_id"),
        *[count(i).alias(f"n_{rule.name}") for i, rule in enumerate(RULES)],
        F.sha2(named.cast("binary"), 256).alias("base_sha256"),
        named.alias("spans"),
    )


# RE2 folds more than A-Z without case, so the letters are written out.
_ASSIGN = "".join(
    f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)"
) + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
ORACLE = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
rules(kind, name, least) AS (VALUES (0, 'assign', 6), (1, 'access', 20), (2, 'hex', 24)),
found AS (
    SELECT doc_id, 0 AS kind, regexp_split_to_array(t, '{_ASSIGN}') AS parts, regexp_extract_all(t, '{_ASSIGN}', 0) AS hits,
           regexp_extract_all(t, '{_ASSIGN}', 2) AS measured FROM texts
    UNION ALL
    SELECT doc_id, 1, regexp_split_to_array(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'),
           regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM texts
    UNION ALL
    SELECT doc_id, 2, regexp_split_to_array(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'),
           regexp_extract_all(t, '[0-9a-f]+') FROM texts
),
each AS (
    SELECT doc_id, kind, unnest(range(1, len(hits) + 1)) AS place, unnest(parts[1:len(hits)]) AS part,
           unnest(hits) AS hit, unnest(measured) AS value FROM found
),
placed AS (
    SELECT doc_id, kind, length(hit) AS own, length(value) AS size,
           sum(length(part) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY place)::BIGINT AS stop FROM each
),
spans AS (
    SELECT doc_id, kind, string_agg(name || ':' || (stop - own) || ':' || stop, ',' ORDER BY stop - own, kind) AS one,
           stop - own AS start
    FROM placed JOIN rules USING (kind) WHERE size >= least GROUP BY doc_id, kind, stop - own
),
per_doc AS (
    SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
           count(*) FILTER (kind = 2) AS n_hex, string_agg(one, ',' ORDER BY start, kind) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per_doc USING (doc_id)
"""
