"""Packing of token sequences with balanced cost and no padding.

A piece of n tokens costs ``LINEAR`` * n + ``QUADRATIC`` * n * n: a part for every token, and one for every pair of tokens that
attend to each other. Documents are taken from the dearest to the cheapest, and each goes to the sequence of lowest cost so far
that has room for it. Where none has, it is cut: the cheapest sequence that has any room is filled, and the rest of
the document takes its turn among the others. Documents longer than a sequence fill sequences of their own first.

Documents are packed where they are tokenized: a task deals groups of at most ``GROUP_ROWS`` documents, or ``GROUP_BYTES`` of
ids, into as many whole sequences as the group's tokens fill, so token ids are never shuffled. What a group has left, less than
one sequence, is packed in a second round: all groups' leftovers are dealt by hash into groups of bounded size, and the
tokens that fill no whole sequence there get sequences whose lengths are powers of two, which need no padding
either. So every sequence is full, however the documents lie in partitions.

The first round's rows are a written table: both rounds read the same sequences wherever a task runs again.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import read, shared, staged
from tallyhouse.llm.token_counts import SPLIT, byte_letters, default_vocabulary

CAPACITY = 1024
END = 0
# A token's share of a layer of width 1,024 against that of a pair of tokens.
LINEAR, QUADRATIC = 6_144, 1
GROUP_ROWS = 20_000
GROUP_BYTES = 32 << 20
_EMIT_BYTES = 8 << 20
_TEXTS_AT_ONCE = 500


class ByteEncoder:
    """Token ids of a byte-level BPE file of the tokenizers library, as little-endian unsigned 32-bit numbers.

    Merges run by the rank of their result. That gives the library's ids if ranks follow the order of the merges and the
    merges make every token of its own letters, which is checked here; other vocabularies are refused.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.spec = spec
        loaded, model = json.loads(spec), Tokenizer.from_str(spec).model
        vocab = loaded["model"]["vocab"]
        added = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        merges = [m if isinstance(m, list) else m.split(" ") for m in loaded["model"]["merges"]]
        made = [vocab[left + right] for left, right in merges]
        alone = all([t.id for t in model.tokenize(token)] == [id_] for token, id_ in vocab.items() if token not in added)
        byte_level = (loaded["pre_tokenizer"] or {}).get("type") == "ByteLevel" and not loaded["pre_tokenizer"]["add_prefix_space"]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in loaded["added_tokens"])
        if not byte_level or not plain or loaded["normalizer"] or not alone or made != sorted(set(made)):
            raise ValueError("a byte-level vocabulary whose tokens are in the order of their merges is needed")
        of_letter = {letter: byte for byte, letter in byte_letters().items()}
        self.ranks = {bytes(of_letter[c] for c in token): id_ for token, id_ in vocab.items() if token not in added}
        self.added = added
        self._ready()

    def _ready(self) -> None:
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.encoding = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=self.ranks, special_tokens=self.added)
        self.library = None

    def __getstate__(self):
        return {"spec": self.spec, "ranks": self.ranks, "added": self.added}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self._ready()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        except ValueError:  # runs of white space that are too long for its pattern
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_str(self.spec)
                self.library.no_truncation()
                self.library.no_padding()
            ids = self.library.encode(text, add_special_tokens=False).ids
            return b"".join(id_.to_bytes(4, "little") for id_ in ids)


def cost(length):
    """Of a piece of ``length`` tokens (a number or a column)."""
    return LINEAR * length + QUADRATIC * length * length


def deal(sizes: list[int], capacities: list[int]) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Places of documents of the given sizes in sequences: (document, start, length, sequence, offset) of each piece, in
    the order of placing, and (document, start, length) of what is left when all sequences are full.

    Equal documents go in their order, and of equally cheap sequences the first is taken.
    """
    waiting = [(-size, doc, 0) for doc, size in enumerate(sizes) if size]
    heapify(waiting)
    room, costs = list(capacities), [0] * len(capacities)
    # A sequence is in ``open`` while it holds the document in turn, and so all later ones, else in ``closed``, by its room.
    open_: list[tuple[int, int]] = []
    closed = [(-capacity, seq) for seq, capacity in enumerate(capacities)]
    cheapest: list[tuple[int, int]] = [(0, seq) for seq in range(len(capacities))]
    heapify(closed)
    placed = []
    while waiting:
        size, doc, start = waiting[0]
        size = -size
        while closed and -closed[0][0] >= size:
            free, seq = heappop(closed)
            if room[seq] == -free:
                heappush(open_, (costs[seq], seq))
        if open_:
            seq, length = heappop(open_)[1], size
        else:
            while cheapest and (costs[cheapest[0][1]] != cheapest[0][0] or not room[cheapest[0][1]]):
                heappop(cheapest)
            if not cheapest:
                break
            seq = heappop(cheapest)[1]
            length = room[seq]
        heappop(waiting)
        placed.append((doc, start, length, seq, capacities[seq] - room[seq]))
        if length < size:
            heappush(waiting, (length - size, doc, start + length))
        room[seq] -= length
        costs[seq] += cost(length)
        if room[seq]:
            heappush(cheapest, (costs[seq], seq))
            if room[seq] >= size:
                heappush(open_, (costs[seq], seq))
            else:
                heappush(closed, (-room[seq], seq))
    return placed, [(doc, start, -size) for size, doc, start in sorted(waiting)]


def powers_of_two(n: int) -> list[int]:
    """Powers of two that add up to ``n``, largest first."""
    return [1 << bit for bit in range(n.bit_length() - 1, -1, -1) if n >> bit & 1]


# left: not placed yet; sequence_id then only numbers the row.
ROWS = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, left boolean"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    names = [field.split(" ")[0] for field in ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _first_round(encoder: ByteEncoder, texts: Iterator[tuple], numbers: Iterator[int], capacity: int, last: bytes) -> Iterator[tuple]:
    width = 4 * capacity
    group: list[tuple] = []
    size = 0

    def packed() -> Iterator[tuple]:
        sizes = [len(ids) // 4 for _, _, ids, _ in group]
        whole = sum(sizes) // capacity
        sequences = [next(numbers) for _ in range(whole)]
        placed, left = deal(sizes, [capacity] * whole)
        for doc, at, length, seq, offset in placed:
            doc_id, start, ids, n = group[doc]
            yield doc_id, start + at, length, ids[4 * at : 4 * (at + length)], n, sequences[seq], offset, False
        for doc, at, length in left:
            doc_id, start, ids, n = group[doc]
            yield doc_id, start + at, length, ids[4 * at : 4 * (at + length)], n, next(numbers), 0, True

    for doc_id, text in texts:
        ids = encoder.ids(text) + last
        n, whole = len(ids) // 4, len(ids) // width * width
        for first in range(0, whole, width):
            yield doc_id, first // 4, capacity, ids[first : first + width], n, next(numbers), 0, False
        if whole < len(ids):
            group.append((doc_id, whole // 4, ids[whole:], n))
            size += len(ids) - whole
            if len(group) >= GROUP_ROWS or size >= GROUP_BYTES:
                yield from packed()
                group, size = [], 0
    yield from packed()


def first_round(docs: DataFrame, path: str | None, capacity: int, end: int) -> DataFrame:
    with open(path or default_vocabulary(), encoding="utf-8") as file:
        the_encoder = shared(docs.sparkSession, ByteEncoder(file.read()))
    last = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 34
        numbers = iter(range(first, first + (1 << 34), 2))
        rows, size = [], 0
        for row in _first_round(the_encoder(), _texts(batches), numbers, capacity, last):
            rows.append(row)
            size += len(row[3]) + 64
            if size > _EMIT_BYTES:
                yield _rows(rows)
                rows, size = [], 0
        if rows:
            yield _rows(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for first in range(0, batch.num_rows, _TEXTS_AT_ONCE):
            part = batch.slice(first, _TEXTS_AT_ONCE)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def second_round(left: DataFrame, capacity: int) -> DataFrame:
    """Leftovers of all groups in whole sequences, and in sequences of powers of two what fills none."""
    total = left.agg(F.count("*").alias("rows"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).first()
    groups = max(1, math.ceil(total["rows"] / GROUP_ROWS), math.ceil(4 * total["tokens"] / GROUP_BYTES))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns(["group"]).to_pylist(), key=lambda r: r["sequence_id"])
        tokens = sum(r["length"] for r in rows)
        capacities = [capacity] * (tokens // capacity) + powers_of_two(tokens % capacity)
        placed, _ = deal([r["length"] for r in rows], capacities)
        first, out = (key[0].as_py() << 34) + 1, []
        for row, at, length, seq, offset in placed:
            r = rows[row]
            ids = r["ids"][4 * at : 4 * (at + length)]
            out.append((r["doc_id"], r["start"] + at, length, ids, r["doc_tokens"], first + 2 * seq, offset, False))
        return pa.Table.from_batches([_rows(out)])

    group = F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("group")
    return left.select("*", group).groupBy("group").applyInArrow(run, ROWS)


def _packed(
    docs: DataFrame, value: Callable[[Column], Column], name: str, path: str | None, capacity: int, end: int
) -> DataFrame:
    if capacity < 1:
        raise ValueError("a sequence needs room for one token")
    columns = ["doc_id", "start", "length", name, "doc_tokens", "sequence_id", "offset"]
    # Of what is placed only the value asked for is written.
    first = first_round(docs, path, capacity, end).select("*", F.when(~F.col("left"), value(F.col("ids"))).alias("_value"))
    first = staged(first.withColumn("ids", F.when(F.col("left"), F.col("ids"))), "first-round")
    done = first.filter("not left").drop("ids").withColumnRenamed("_value", name).select(columns)
    again = second_round(first.filter("left").drop("_value"), capacity).withColumn("ids", value(F.col("ids")))
    both = done.unionByName(again.withColumnRenamed("ids", name).select(columns))
    return both.withColumn("cost", cost(F.col("length")))


def sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Every piece of ``docs`` (doc_id, text) with its place: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset, cost.

    A document is its ids and an end id; a null or empty text is the end id alone. Each id lies in one piece. All
    sequences have ``capacity`` tokens, or a power of two (at most one of each a leftover group). Repeated rows and rows
    without doc_id are packed each; other columns are not read; an empty table gives no rows. A very long text is held whole in
    its task, and cut there. Documents of equal length go in the order of the table.
    """
    return _packed(docs, lambda ids: ids, "ids", path, capacity, end)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """As ``sequences``, with ids_crc32 (a digest of the ids) in place of the ids."""
    return _packed(docs, F.crc32, "ids_crc32", path, capacity, end)


def op13_cost_balanced_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"))
