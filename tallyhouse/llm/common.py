"""What several operators share: tables written on the way, memos, sorted groups in tasks, connected components."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.workdir import new_folder

# Rows of one key that a task takes whole; the rows of a larger one are compared in blocks, many tasks to a key.
BLOCK_ROWS = 8_192
# Distinct words a memo holds before it drops those it no longer meets, and the longest word it holds.
MEMO_ENTRIES = 200_000
MEMO_KEY_CHARS = 64


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder. What is read from it later is computed once, wherever tasks run again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def key_text(column: Column) -> Column:
    """A key as text that is never null; a null key differs from every text of digits."""
    return F.coalesce(column.cast("string"), F.lit("null"))


def crc32_of_id(column: str | Column) -> Column:
    """crc32 of an id written as text; null for a null id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary"))


def shared(spark: SparkSession, value) -> Callable[[], object]:
    """A function that gives ``value`` in any task. It is broadcast once, and a Python worker that runs several tasks
    makes it once, so that the memos in it last; a worker keeps the last two such values, and none after ``forget``.

    It travels as bytes, which need no import of this library where the workers run.
    """
    sent, name = spark.sparkContext.broadcast(cloudpickle.dumps(value)), uuid.uuid4().hex

    def get():
        made = sys.modules.setdefault("_worker_values", types.ModuleType("_worker_values")).__dict__
        own = made.setdefault("values", {})
        if name not in own:
            while len(own) > 1:
                del own[next(iter(own))]
            own[name] = cloudpickle.loads(sent.value)
        return own[name]

    return get


def forget() -> None:
    """For tasks that need no shared value: drops those that earlier tasks left in this worker."""
    if "_worker_values" in sys.modules:
        sys.modules["_worker_values"].__dict__.pop("values", None)


class Memo(dict):
    """``compute`` with a bounded memory: when it is full, entries not used since the last time go."""

    def __init__(self, compute: Callable[[str], object], entries: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.entries, self.older = compute, entries, {}

    def __missing__(self, key):
        value = self.older.get(key, self)
        if value is self:
            value = self.compute(key)
            if len(key) > MEMO_KEY_CHARS:
                return value
        if len(self) >= self.entries:
            self.turn()
        self[key] = value
        return value

    def turn(self) -> None:
        self.older = dict(self)
        self.clear()


def sorted_groups(
    batches: Iterable[pa.RecordBatch], key: str, limit: int
) -> Iterator[tuple[pa.RecordBatch | pa.Table, np.ndarray, bool]]:
    """Whole groups out of batches that are sorted by the long column ``key``: (rows, first row of each group, large).

    Several groups come together. A group of more than ``limit`` rows comes alone, in pieces, marked large; its
    pieces are never joined, so memory is bounded by the batch and the limit.
    """
    held: list[pa.RecordBatch] = []
    held_rows, large_key = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        if large_key is not None:
            end = int(np.searchsorted(keys, large_key, side="right"))
            if end:
                yield batch.slice(0, end), np.zeros(1, np.int64), True
            if end == len(keys):
                continue
            batch, keys, large_key = batch.slice(end), keys[end:], None
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        if held and keys[0] != held[0].column(held[0].schema.get_field_index(key))[0].as_py():
            yield from _whole(held, key, limit)
            held, held_rows = [], 0
        if last:
            yield from _whole([*held, batch.slice(0, last)], key, limit)
            held, held_rows = [batch.slice(last)], batch.num_rows - last
        else:
            held.append(batch)
            held_rows += batch.num_rows
        if held_rows > limit:
            large_key = keys[-1]
            for part in held:
                yield part, np.zeros(1, np.int64), True
            held, held_rows = [], 0
    if held:
        yield from _whole(held, key, limit)


def _whole(parts, key, limit):
    rows = pa.Table.from_batches(parts).combine_chunks()
    keys = rows.column(key).to_numpy()
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    for at in np.flatnonzero(sizes > limit):
        yield rows.slice(starts[at], sizes[at]), np.zeros(1, np.int64), True
    if (sizes <= limit).all():
        yield rows, starts, False
        return
    keep = np.repeat(sizes <= limit, sizes)
    if keep.any():
        rows = rows.filter(pa.array(keep))
        kept = sizes[sizes <= limit]
        yield rows, np.r_[0, np.cumsum(kept)[:-1]].astype(np.int64), False


def block_pairs(rows: DataFrame, key: str, by: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Copies of ``rows`` such that any two rows of a key meet in one group of bounded size.

    A key with n rows is dealt into ceil(n / block_rows) blocks by the hash of ``by``. New columns: ``pair``
    (long, the group), ``side`` (0 or 1: the block the row comes from) and ``alone`` (both blocks are the same).
    Compare rows of different sides, or all rows where ``alone``.
    """
    sizes = staged(rows.groupBy(key).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")), "block-sizes")
    own = F.pmod(F.xxhash64(by), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.join(sizes, key).withColumn("own", own).withColumn("other", other)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return (
        dealt.withColumn("pair", F.xxhash64(F.col(key), low, high))
        .withColumn("side", (F.col("own") > F.col("other")).cast("int"))
        .withColumn("alone", F.col("own") == F.col("other"))
        .drop("blocks", "own", "other")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long): component is the smallest node that can be reached.

    Alternating large-star and small-star steps: rounds grow with the logarithm of a component's size, and the
    number of edges never grows. Every round's edges are a written table, so a lost executor costs one round.
    The least neighbours are written before they are joined: both sides of that join are then plain scans, which
    adaptive execution can split where one node has very many edges. No edges: no rows.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = staged(edges.filter("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    while True:
        many = now.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
        chained = now.join(now.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
        if many.unionByName(chained).isEmpty():
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = staged(large.distinct(), "large-star")
        least = staged(large.groupBy("a").agg(F.min("b").alias("least")), "least")
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
        now = staged(moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "small-star")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def spanning_links(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect rows 0..n-1 as ``near(row, others)`` (which of ``others`` are linked to it) does: at most n - 1."""
    left, links = np.arange(n), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            row = queue.pop()
            hit = near(row, left)
            if hit.any():
                found = left[hit]
                links.extend((row, int(x)) for x in found)
                queue.extend(found.tolist())
                left = left[~hit]
    return links
