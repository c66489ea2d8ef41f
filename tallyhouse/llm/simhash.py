"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two, and each segment is mapped to its bit count (0, 1 or 2).
Two fingerprints cannot differ in fewer bits than the Manhattan distance of their counts, so a join within that
distance loses nothing. The join runs on a grid of unit cells over each half of the counts: of two points within
4, one half must be within 2, and then both reach a common cell by one step at most. Every point is entered into
its own cell and those one step away (25 a half on average, whatever the data), and whoever meets in a cell is
verified on the fingerprints themselves.

Equal fingerprints are one node, so copies cost one row. Only links that span a cell's groups leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import (
    BLOCK_ROWS, block_pairs, components, forget, free_name, key_text, read, sorted_groups, spanning_links, staged,
)

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
_EVERY_SECOND_BIT = np.uint64(0x5555555555555555)
_HASHES_AT_ONCE = 65_536
_SMALL = 64


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set when it is set in over half of the hashes of the text's word shingles, repeats included."""
    tokens = text.encode("utf-8").lower().split() if text else []  # of bytes: ASCII letters, ASCII white space
    if not tokens:
        return 0
    digest = xxhash.xxh64_digest
    if len(tokens) < words:
        return int.from_bytes(digest(b" ".join(tokens), SEED), "big")
    ones, n = np.zeros(64, np.int64), len(tokens) - words + 1
    for first in range(0, n, _HASHES_AT_ONCE):
        part = tokens[first : min(first + _HASHES_AT_ONCE, n) + words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(words))))
        raw = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), np.uint8)
        ones += np.unpackbits(raw.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_column(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a long with the same 64 bits. Null and empty texts have fingerprint zero."""

    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        for texts in batches:
            bits = np.array([fingerprint(t, words) for t in texts], np.uint64)
            yield pd.Series(bits.view(np.int64))

    return fingerprints(text)


def cells(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every cell each fingerprint is entered in: its own and those one step away, for both halves."""
    counts = (bits & _EVERY_SECOND_BIT) + (bits >> np.uint64(1) & _EVERY_SECOND_BIT)
    rows, found, every = [], [], np.arange(len(bits))
    for half in range(2):
        point = (counts >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        tag = np.int64(half) << 32
        rows.append(every)
        found.append(point | tag)
        for segment in range(16):
            step, value = np.int64(1) << (2 * segment), point >> (2 * segment) & 3
            for moved, where in ((point + step, value < 2), (point - step, value > 0)):
                rows.append(every[where])
                found.append(moved[where] | tag)
    return np.concatenate(rows), np.concatenate(found)


def similar_fingerprints(points: DataFrame, max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``points`` (column fp, long) that connect whatever is
    within ``max_bits`` (4 at most), directly or over others in the same cell. Not every linked pair is listed."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the grid is made for at most 4 differing bits")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy()
            for first in range(0, len(bits), 20_000):
                part = bits[first : first + 20_000]
                row, cell = cells(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(part[row])], ["cell", "fp"])

    def compare(key: str):
        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, starts, _ in sorted_groups(batches, key, 1 << 40):
                a, b = _in_groups(rows.column("fp").to_numpy(), starts, max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        return within

    # Two points in a cell are not within the Manhattan distance for sure; the exact test of the bits implies it.
    entered = points.select("fp").mapInArrow(enter, "cell long, fp long")
    # Cells are counted before their points move: a large one goes in blocks from the start, many tasks to a cell.
    sizes = entered.groupBy("cell").agg(F.count("*").alias("n"))
    large = staged(sizes.filter(F.col("n") > block_rows).select("cell"), "large-cells")
    some_large = not large.isEmpty()
    whole = entered.join(large, "cell", "left_anti") if some_large else entered
    links = whole.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare("cell"), "a long, b long")
    links = staged(links, "met")
    if not some_large:
        return links
    rows = staged(entered.join(large, "cell", "left_semi"), "large-cell-points")
    dealt = block_pairs(rows, "cell", "fp", block_rows).select("pair", "fp").repartition("pair")
    return links.unionByName(dealt.sortWithinPartitions("pair").mapInArrow(compare("pair"), "a long, b long"))


def _in_groups(bits: np.ndarray, starts: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within each group: all of a small group at once, and a spanning set of a larger one."""
    raw, ends = bits.view(np.uint64), np.r_[starts[1:], len(bits)]
    sizes = ends - starts
    a, b = [], []
    group_end = np.repeat(np.where(sizes <= _SMALL, ends, 0), sizes)
    row, step = np.flatnonzero(np.arange(len(bits)) + 1 < group_end), 1
    while len(row):
        near = np.bitwise_count(raw[row] ^ raw[row + step]) <= max_bits
        a.append(bits[row[near]])
        b.append(bits[row[near] + step])
        step += 1
        row = row[row + step < group_end[row]]
    for g in np.flatnonzero(sizes > _SMALL):
        own = np.unique(raw[starts[g] : ends[g]])
        pairs = np.array(
            spanning_links(len(own), lambda i, others: np.bitwise_count(own[others] ^ own[i]) <= max_bits), np.int64
        ).reshape(-1, 2)
        own = own.view(np.int64)
        a.append(own[pairs[:, 0]])
        b.append(own[pairs[:, 1]])
    none = [np.zeros(0, np.int64)]
    a, b = np.concatenate(a or none), np.concatenate(b or none)
    low, high = np.minimum(a, b), np.maximum(a, b)
    differ = low != high
    pairs = np.unique(np.stack([low[differ], high[differ]], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def fingerprint_classes(docs: DataFrame, words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, row_hash, fp) and (classes: fp, least doc_id of all that the fingerprint reaches), both written."""
    rows = staged(
        docs.select("doc_id", F.xxhash64("text").alias("row_hash"), fingerprint_column(F.col("text"), words).alias("fp")),
        "fingerprints",
    )
    points = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    reached = staged(components(similar_fingerprints(points, max_bits)), "fingerprint-components")
    joined = points.join(reached, F.col("fp") == F.col("node"), "left")
    joined = joined.select("fp", F.coalesce("component", "fp").alias("class"), "least")
    smallest = staged(joined.groupBy("class").agg(F.min("least").alias("component_id")), "class-least")
    return rows, staged(joined.join(smallest, "class").select("fp", "class", "component_id"), "classes")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs`` (doc_id, text; other columns are not read).

    Null, empty and blank texts have fingerprint zero and link like any other. Repeated rows each give a row. A row
    without doc_id takes part; component_id ignores such ids and is null if a group has no other. An empty table
    gives no rows.
    """
    rows, classes = fingerprint_classes(docs, words, max_bits)
    fingerprint_text = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(classes, "fp").select("doc_id", fingerprint_text, "component_id")


def one_of_each_group(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with exactly one row of each group of near-duplicates: that of the smallest doc_id (ids before null;
    of rows with the same id the one with the smallest hash of its text). All columns stay, whatever they are called.
    """
    rows, classes = fingerprint_classes(docs, words, max_bits)
    first = Window.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last(), "row_hash")
    kept = (
        rows.join(classes.select("fp", "class"), "fp")
        .withColumn("place", F.row_number().over(first))
        .filter("place = 1")
        .select("doc_id", "row_hash", "class")
    )
    kept = staged(kept.select(F.struct(key_text(F.col("doc_id")), "row_hash").alias("kept_key")), "kept")
    repeated = rows.groupBy("doc_id", "row_hash").agg(F.count("*").alias("n")).filter("n > 1")
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, F.struct(key_text(F.col("doc_id")), F.xxhash64("text")))
    out = keyed.join(kept.hint("shuffle_hash"), F.col(key) == F.col("kept_key"), "left_semi")
    if not repeated.isEmpty():
        out = out.dropDuplicates([key])
    return out.drop(key)


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents").select("doc_id", "text"))
