"""Near-duplicate embeddings by Euclidean p-stable hashing, verified by exact cosine.

Vectors are scaled to length one, where a cosine is a Euclidean distance. Each of ``tables`` hash tables projects
them on ``projections`` random directions, shifts, and cuts each axis into cells of ``width``; vectors with the same
label and the same cells in a table share a bucket. Whoever shares a bucket is compared exactly in double precision.
A pair that meets in several tables is counted in the first of them only.

Equal vectors with the same label are one class, so copies are never compared. Tasks return sums of links for each
class and links that span a bucket, never all pairs. Buckets of any size are compared whole, large ones in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import block_pairs, components, read, sorted_groups, spanning_links, staged

LEAST_COSINE = 0.98


@dataclass(frozen=True)
class Hashing:
    """At cosine 0.98 (distance 0.2) one axis keeps a pair together with probability 0.80, a table with 0.26, and one of
    16 tables with 0.99; closer pairs more often. Larger collections need more projections and more tables."""

    tables: int = 16
    projections: int = 6
    width: float = 0.8
    seed: int = 20_240_229

    def axes(self, dimension: int) -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng([self.seed, dimension])
        n = self.tables * self.projections
        return random.standard_normal((dimension, n)), random.uniform(0, self.width, n)


BLOCK_ROWS = 2_048


def unit_vectors(column: pa.Array) -> np.ndarray:
    """Rows of one length as double-precision unit vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    # By a power of two first, which is exact, so that no square is too large or too small for a double.
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def bucket_keys(unit: np.ndarray, label: np.ndarray, hashing: Hashing) -> np.ndarray:
    """One 64-bit key for each row and table, of the label, the table and the cells."""
    directions, shift = hashing.axes(unit.shape[1])
    cells = np.floor((unit @ directions + shift) / hashing.width).astype(np.int64).view(np.uint64)
    cells = cells.reshape(len(unit), hashing.tables, hashing.projections)
    key = label.astype(np.int64).view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(
        hashing.tables, dtype=np.uint64
    ) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(unit.shape[1])
    for axis in range(hashing.projections):
        key = (key ^ cells[:, :, axis]) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _hashed(batches: Iterator[pa.RecordBatch], hashing: Hashing) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, label, size = (batch.column(i).to_numpy() for i in (0, 1, 2))
        for dimension in np.unique(size):
            at = np.flatnonzero(size == dimension)
            unit = unit_vectors(batch.column(3).take(pa.array(at)))
            keys = bucket_keys(unit, label[at], hashing)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, keys.size + 1, hashing.tables), pa.int32()), pa.array(keys.ravel())
            )
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), lists], ["id", "keys"])


FOUND = "kind int, a long, b long"
_LINKS, _EDGE = 0, 1


def _compare(rows: pa.Table, least: float, side: np.ndarray | None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Of one bucket: links of each row weighted by class sizes, as far as they are counted here, and spanning links."""
    unit = unit_vectors(rows.column("embedding").combine_chunks())
    n = rows.column("n").to_numpy()
    table = rows.column("table")[0].as_py()
    flat = rows.column("keys").combine_chunks().flatten().to_numpy()
    earlier = flat.reshape(len(n), -1)[:, :table]
    links = np.zeros(len(n), np.int64)
    near = np.zeros((len(n), len(n)), bool)
    step = max(1, 4_000_000 // len(n))
    for first in range(0, len(n), step):
        part = slice(first, first + step)
        near[part] = unit[part] @ unit.T >= least
        if side is not None:
            near[part] &= side[part, None] != side[None, :]
        near[np.arange(first, min(first + step, len(n))), np.arange(first, min(first + step, len(n)))] = False
        counted = near[part].copy()
        for other in range(table):
            counted &= earlier[part, other][:, None] != earlier[None, :, other]
        links[part] = counted @ n
    return links, spanning_links(len(n), lambda i, others: near[i, others])


def _compared(batches: Iterator[pa.RecordBatch], key: str, least: float) -> Iterator[pa.RecordBatch]:
    for rows, starts, _ in sorted_groups(batches, key, 1 << 40):
        kind, a, b = [], [], []
        for first, last in zip(starts, np.r_[starts[1:], rows.num_rows]):
            for group in _alike(rows.slice(first, last - first)):
                if group.num_rows < 2:
                    continue
                sides = group.column("side").to_numpy() if "side" in group.schema.names and not group.column("alone")[0].as_py() else None
                links, edges = _compare(group, least, sides)
                own = group.column("id").to_numpy()
                some = np.flatnonzero(links)
                kind += [_LINKS] * len(some) + [_EDGE] * len(edges)
                a += own[some].tolist() + [int(own[i]) for i, _ in edges]
                b += links[some].tolist() + [int(own[j]) for _, j in edges]
        if kind:
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"]
            )


def _alike(group: pa.Table) -> Iterator[pa.Table]:
    """The rows of a bucket by label, length and table: keys of 64 bits might meet by chance."""
    kinds = np.stack([group.column(c).to_numpy() for c in ("label", "d", "table")], axis=1)
    if (kinds == kinds[0]).all():
        yield group
        return
    different, of = np.unique(kinds, axis=0, return_inverse=True)
    for i in range(len(different)):
        yield group.filter(pa.array(of.ravel() == i))


def similar_classes(classes: DataFrame, least: float, hashing: Hashing, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(kind, a, b) for ``classes`` (id long, unique; label; embedding without bad values; n rows): kind 0 says that
    class a has b more links, kind 1 that a and b are linked (enough of these to connect what is linked)."""
    hashed = staged(
        classes.select("id", F.col("label").cast("long").alias("label"), F.size("embedding").alias("d"), "embedding")
        .mapInArrow(lambda batches: _hashed(batches, hashing), "id long, keys array<long>"),
        "hashed",
    )
    keys = hashed.select("id", F.posexplode("keys").alias("table", "bucket"))
    # Only what shares a bucket moves with its vector. Sizes are known before anything moves: a bucket of more than block_rows
    # rows goes in blocks from the start, many tasks to a bucket.
    sizes = staged(keys.groupBy("bucket").agg(F.count("*").alias("rows")).filter("rows > 1"), "bucket-sizes")
    met = staged(keys.join(sizes, "bucket").select("bucket", "table", "id", (F.col("rows") > block_rows).alias("large")), "met")
    facts = classes.select("id", F.col("label").cast("long").alias("label"), F.size("embedding").alias("d"), "embedding", "n")
    vectors = staged(hashed.join(facts, "id"), "vectors")
    columns = ["table", "id", "label", "d", "embedding", "n", "keys"]

    def within(key: str):
        return lambda batches: _compared(batches, key, least)

    whole = met.filter("not large").join(vectors, "id").select("bucket", *columns).repartition("bucket")
    found = staged(whole.sortWithinPartitions("bucket").mapInArrow(within("bucket"), FOUND), "found")
    large = met.filter("large").select("bucket", "table", "id")
    if large.isEmpty():
        return found
    dealt = block_pairs(large, "bucket", "id", block_rows // 2).join(vectors, "id").select("pair", "side", "alone", *columns)
    more = dealt.repartition("pair").sortWithinPartitions("pair").mapInArrow(within("pair"), FOUND)
    return found.unionByName(staged(more, "found-in-blocks"))


def near_duplicates(
    vectors: DataFrame, least: float = LEAST_COSINE, hashing: Hashing = Hashing(), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label).

    Rows are compared when their labels are equal and not null and their vectors equally long. A vector that is null,
    empty, zero, or holds a null, NaN or infinity links with nothing and is its own component. Repeated rows are
    vectors of their own and link with each other. Rows without vec_id are compared too; they are not named as a
    component, and a component of such rows only is null and keeps none. Vectors of any length are compared whole, and doubles
    of any size. Other columns are not read; an empty table gives no rows.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine must be above 0 and at most 1")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    empty = ~F.exists("embedding", lambda x: x != 0)
    usable = F.col("label").isNotNull() & F.coalesce(~bad & ~empty, F.lit(False))
    rows = staged(vectors.select("vec_id", "embedding", "label", usable.alias("usable")), "vectors-in")
    grouped = rows.filter("usable").groupBy("label", "embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    classes = staged(grouped.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    found = similar_classes(classes.select("id", "label", "embedding", "n"), least, hashing, block_rows)
    links = found.filter(F.col("kind") == _LINKS).groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links"))
    reached = components(found.filter(F.col("kind") == _EDGE).select("a", "b"))
    whole = (
        classes.select("id", "label", "embedding", "n", "first")
        .join(links, "id", "left")
        .join(reached.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    whole = staged(whole, "vector-links")
    least_id = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    whole = staged(
        whole.join(least_id, "component").select(
            "label", "embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
        ),
        "vector-components",
    )
    linked = rows.filter("usable").join(whole, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", kept)


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "embeddings"))
