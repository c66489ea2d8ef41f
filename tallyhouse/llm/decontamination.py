"""Benchmark decontamination by size-partitioned MinHash containment search, verified by exact shingle containment.

A test item is short and a document long, so their Jaccard similarity is near zero and equal-length signatures would
need thousands of hashes. The small set is sketched instead: an item's sketch is the shingles with the least hash
values, and each sketch value is looked up in the whole document's shingle hashes. Items are partitioned by the
number of their shingles, and each partition asks for ``hits`` sketch values. The sketch is as long as makes the
search exact: with q shingles of which at least ``need`` must occur, any q - need + hits of them hold ``hits`` that
do. Documents too small for a partition are passed over. Candidates are verified on the words themselves.

Items are taken in blocks of bounded size, each broadcast and held against all documents; documents never move.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import free_name, read, shared

SHINGLE_WORDS = 5
LEAST_CONTAINMENT = 0.8
ITEMS_PER_BLOCK = 20_000
CHARS_PER_BLOCK = 20_000_000
MATCHES = "array<struct<item:long,shared:long,shingles:long>>"
_WORDS = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def _mixed(values: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers that keeps them distinct."""
    values = (values ^ values >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ values >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ values >> np.uint64(33)


class ItemIndex:
    """A block of items. Words are numbered; a word that no item has is number 0 and breaks every shingle."""

    def __init__(self, items: list[tuple[int, str]], words: int, least: float):
        """items: (number, text). An item of fewer words is a single shingle; one without words matches nothing."""
        self.number: dict[str, int] = {}
        self.words = words
        self.shingles: dict[int, tuple[int, frozenset[tuple[int, ...]]]] = {}
        postings: dict[int, dict[int, list[int]]] = {}
        self.partitions: dict[int, tuple[int, int]] = {}  # by item: (hits wanted, shingles needed)
        bound = Fraction(str(least))
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            if not ids:
                continue
            length = min(words, len(ids))
            own = frozenset(tuple(ids[i : i + length]) for i in range(len(ids) - length + 1))
            need = math.ceil(bound * len(own))
            hits = min(need, 1 + (len(own).bit_length() - 1) // 3)  # by size partition: powers of two
            sketch = np.sort(self.hashes(np.array(sorted(own), np.uint64).T, length))[: len(own) - need + hits]
            for value in sketch.tolist():
                postings.setdefault(length, {}).setdefault(value, []).append(item)
            self.shingles[item] = (length, own)
            self.partitions[item] = (hits, need)
        self.sketches = {
            length: (np.array(sorted(found), np.uint64), [found[v] for v in sorted(found)])
            for length, found in postings.items()
        }

    @staticmethod
    def hashes(columns, length: int) -> np.ndarray:
        total = np.zeros(len(columns[0]), np.uint64)
        for i in range(length):
            total = total * np.uint64(0x9E3779B97F4A7C15) + columns[i]
        return _mixed(total)

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, shared shingles, its shingles) of every item whose containment in the text reaches the bound."""
        found = words_of(text)
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in found), np.uint64, len(found))
        out = []
        for length, (values, owners) in self.sketches.items():
            if len(ids) < length:
                continue
            known = ids != 0
            whole = known[: len(ids) - length + 1].copy()
            for i in range(1, length):
                whole &= known[i : len(ids) - length + 1 + i]
            at = np.flatnonzero(whole)
            if not len(at):
                continue
            columns = [ids[at + i] for i in range(length)]
            hashed = self.hashes(columns, length)
            place = np.minimum(np.searchsorted(values, hashed), len(values) - 1)
            hit = np.unique(place[values[place] == hashed])
            if not len(hit):
                continue
            tally: dict[int, int] = {}
            for value in hit.tolist():
                for item in owners[value]:
                    tally[item] = tally.get(item, 0) + 1
            in_text: set | None = None
            for item, n in tally.items():
                hits, need = self.partitions[item]
                if n < hits or len(at) < need:
                    continue
                if in_text is None:
                    in_text = set(zip(*(c.tolist() for c in columns)))
                own = self.shingles[item][1]
                common = len(own & in_text)
                if common >= need:
                    out.append((item, common, len(own)))
        return sorted(out)


def _numbered(items: DataFrame) -> DataFrame:
    return items.select("item_id", "text").filter("text is not null").distinct()


def blocks_of(
    items: DataFrame, words: int, least: float, items_per_block: int = ITEMS_PER_BLOCK
) -> Iterator[tuple[ItemIndex, list]]:
    """Indexes of ``items`` (item_id, text), each of about ``items_per_block`` items or ``CHARS_PER_BLOCK`` characters,
    with the item_id of each number."""
    known = _numbered(items)
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(1, math.ceil(size["n"] / items_per_block), math.ceil(size["chars"] / CHARS_PER_BLOCK))
    for block in range(blocks):
        rows = known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows = sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        yield ItemIndex([(i, r["text"]) for i, r in enumerate(rows)], words, least), [r["item_id"] for r in rows]


def matches_column(
    spark: SparkSession,
    text: Column,
    items: DataFrame,
    words: int = SHINGLE_WORDS,
    least: float = LEAST_CONTAINMENT,
    items_per_block: int = ITEMS_PER_BLOCK,
) -> Column:
    """array<struct<item, shared, shingles>> of the items whose shingles the text holds to at least ``least``."""
    if not 0 < least <= 1:
        raise ValueError("the least containment must be above 0 and at most 1")

    def one(index: ItemIndex, ids: list) -> Column:
        the_index = shared(spark, (index, ids))

        @F.pandas_udf(MATCHES)
        def matched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known, names = the_index()
            for texts in batches:
                yield pd.Series(
                    [[{"item": names[i], "shared": n, "shingles": q} for i, n, q in known.matches(t)] for t in texts],
                    dtype="object",
                )

        return matched(text)

    return F.concat(*[one(index, ids) for index, ids in blocks_of(items, words, least, items_per_block)])


def contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """(doc_id, item_id, shared, shingles, containment) for every document and item it holds; no row for others.

    Words are lower-case runs of letters, digits and underscores; shingles are five words, counted once each, over the
    whole document wherever they stand. Null, empty and word-less texts and items match nothing; an item of fewer than
    five words must occur as a whole. Repeated documents give their rows each; an item repeated with the same id and
    text counts once. Other columns are not read; empty tables give no rows.
    """
    found = matches_column(docs.sparkSession, F.col("text"), items, **settings)
    each = docs.select("doc_id", F.explode(found).alias("m"))
    return each.select(
        "doc_id",
        F.col("m.item").alias("item_id"),
        "m.shared",
        "m.shingles",
        (F.col("m.shared") / F.col("m.shingles")).alias("containment"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns as they were."""
    found = free_name(docs, "_items")
    marked = docs.withColumn(found, F.size(matches_column(docs.sparkSession, F.col("text"), items, **settings)))
    return marked.filter(F.col(found) == 0).drop(found)


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


ORACLE = r"""
WITH item_words AS (
    SELECT DISTINCT item_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark WHERE text IS NOT NULL
),
item_shingles AS (
    SELECT DISTINCT item_id, text, least(5, len(w)) AS k,
           unnest(list_transform(range(1, greatest(len(w) - 5, 0) + 2), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM item_words WHERE len(w) > 0
),
sizes AS (SELECT item_id, text, count(*) AS shingles FROM item_shingles GROUP BY item_id, text),
doc_words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents),
doc_shingles AS (
    SELECT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
    FROM doc_words, (SELECT DISTINCT k FROM item_shingles) WHERE len(w) >= k
),
common AS (
    SELECT doc_id, item_id, text, count(*) AS shared
    FROM (SELECT DISTINCT doc_id, k, s FROM doc_shingles) JOIN item_shingles USING (k, s) GROUP BY doc_id, item_id, text
)
SELECT doc_id, item_id, shared, shingles, shared / shingles AS containment
FROM common JOIN sizes USING (item_id, text) WHERE shared * 10 >= shingles * 8
"""
