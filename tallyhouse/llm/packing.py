"""Best-fit packing of token sequences, in bulk-synchronous rounds.

The first round deals the documents (pieces) by hash into ranges of bounded size, each with documents of all sizes, sorted from
large to small. A range gets as many new sequences as its sum fills, and sweeps: a document goes to the smallest gap that holds
it, its successor among the gaps, and the rest of that gap is open again to what comes later. Ranges of like sizes would
not do here: large documents would leave gaps that no small one is there to fill.

What this leaves, a few documents and gaps of a range, goes through further rounds. There documents and gaps are
range-sorted together by size, largest first, and every range sweeps its rows in the same way. What a range cannot
place is matched across ranges. Both lists are ranked within their range, by size, so it is enough to know how many
documents and gaps of each size a range has left: from large to small, the documents of a size take the smallest gaps
that hold them, and where several claim one gap their ranks decide. Every task then looks up its documents' gaps by
rank, the gaps are brought up to date, and the next round begins, with new sequences for what no gap holds: as many
as its sum needs. Each round logs how many documents its sweeps placed, and how many went across ranges.

The driver gets counts by range and size: at most the capacity plus the number of ranges, for documents and for gaps,
whatever the number of rows. Each round's rows are a written table: a lost executor repeats at most that round.
"""

from __future__ import annotations

import gc
import json
import logging
import math
import os
import re
import struct
from bisect import bisect_left, insort
from collections import Counter, namedtuple
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import MEMO_ENTRIES, Memo, read, shared, staged
from tallyhouse.llm.token_counts import byte_letters

log = logging.getLogger(__name__)

CAPACITY = 2048
END = 0
ROWS_PER_RANGE = 20_000
_BYTES_AT_ONCE = 8 << 20
_TEXT_AT_ONCE = 3 << 20

# Fixed value: white space as the tokenizer library has it.
_SPACE = "\t-\r \x85\xa0  -     　"
_SPLIT_ALIKE = re.compile(f"[^{_SPACE}]+").findall
# Texts whose case and normal form need the library: other than Latin letters, and what may become a special token.
# Python's own split takes four characters more for white space.
_ODD = "[\x1c-\x1fİ\u0180-\U0010ffff]|<[|]"
_MARKS = frozenset(",.;:!?")
_BYTE_LETTERS = byte_letters()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Token ids as little-endian unsigned 32-bit numbers, by the tokenizers library.

    The vocabulary's split pattern never reaches across white space and drops it, so a text is the sequence of its
    runs of other characters, and each run's ids are kept for the next time.
    """

    def __init__(self, spec: str):
        self.spec = spec
        split = json.loads(spec)["pre_tokenizer"]["pretokenizers"][0]
        if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("a vocabulary whose split pattern drops white space is needed")
        self._ready()

    def _ready(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(self.spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.of_run = Memo(lambda run: self.encoded([run])[0], MEMO_ENTRIES * 3 // 2)

    def __getstate__(self):
        return {"spec": self.spec}

    def __setstate__(self, state) -> None:
        self.spec = state["spec"]
        self._ready()

    def encoded(self, words: list[str]) -> list[bytes]:
        return [pack_ids(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text. What is new in them is encoded together, which costs a quarter of one by one."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        for at, own in zip(np.flatnonzero(~odd), self.plain_ids(texts.filter(pa.array(~odd)))):
            out[at] = own
        runs = [_SPLIT_ALIKE(text) for text in texts.filter(pa.array(odd)).to_pylist()]
        self.learn(set().union(*runs), False)
        for at, own in zip(np.flatnonzero(odd), runs):
            out[at] = b"".join(map(self.of_run.__getitem__, own))
        return out

    def plain_ids(self, texts: pa.Array) -> Iterator[bytes]:
        """Words are numbered by Arrow, and only distinct ones are looked up. The vocabulary knows lower case only."""
        split = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        numbered = split.flatten().dictionary_encode()
        words, number = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()
        self.learn({word for word in words if word}, True)
        known = [self.of_run[word] if word else b"" for word in words]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        every = np.frombuffer(b"".join(known), "<u4")
        n = sizes[number]
        ends = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat((np.cumsum(sizes) - sizes)[number] - ends[:-1], n) + np.arange(ends[-1])
        ids = every[place]
        bounds = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        for first, last in zip(bounds, bounds[1:]):
            yield ids[first:last].tobytes()

    def learn(self, runs: set[str], plain: bool) -> None:
        known = self.of_run
        fresh = runs.difference(known)
        again = fresh.intersection(known.older)
        fresh -= again
        if len(known) + len(again) + 2 * len(fresh) > known.entries:
            # The memo turns over: all that is wanted now must be in the new one.
            before = known.older
            known.turn()
            known.update((run, before[run]) for run in again)
            again = runs.intersection(known.older)
            fresh = runs.difference(known, again)
        known.update((run, known.older[run]) for run in again)
        # The split pattern parts a word from the mark after it.
        parted = {run: (run[:-1], run[-1]) for run in fresh if run[-1] in _MARKS and run[:-1].isalpha()} if plain else {}
        words = {part for both in parted.values() for part in both}.difference(known) | fresh.difference(parted)
        if plain:
            # A word of Latin letters in lower case is what the vocabulary merges: nothing to normalise or to split.
            whole = {word for word in words if word.isalpha()}
            known.update((word, self.merged(word)) for word in whole)
            words -= whole
        words = list(words)
        for first in range(0, len(words), 10_000):
            part = words[first : first + 10_000]
            known.update(zip(part, self.encoded(part)))
        known.update((run, known[word] + known[mark]) for run, (word, mark) in parted.items())

    def merged(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return pack_ids([token.id for token in self.tokenizer.model.tokenize(letters)])


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


PIECES = "doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids): every document's ids and an end id, cut where they exceed ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers. A null or empty text is the end id alone. Repeated rows and
    rows without doc_id give their own pieces. Only doc_id and text are read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    with open(path or default_vocabulary(), encoding="utf-8") as file:
        the_encoder = shared(spark, Encoder(file.read()))
    last, width = pack_ids([end]), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sets and dicts of texts come and go by the million and hold no cycles: looking for some takes a fifth of the time.
        gc.disable()
        try:
            yield from pieces_of(batches)
        finally:
            gc.enable()

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = the_encoder()
        rows, size = [], 0
        for batch in batches:
            for doc_id, ids in _encoded(batch, encoder):
                ids += last
                for piece, first in enumerate(range(0, len(ids), width)):
                    part = ids[first : first + width]
                    rows.append((doc_id, piece, first // 4, len(part) // 4, part))
                    size += len(part)
                    if size > _BYTES_AT_ONCE:
                        yield _piece_batch(rows)
                        rows, size = [], 0
        if rows:
            yield _piece_batch(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def _encoded(batch: pa.RecordBatch, encoder: Encoder) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids) of each row, some hundred texts or some megabytes at a time."""
    bytes_so_far = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
    first = 0
    while first < batch.num_rows:
        before = bytes_so_far[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(bytes_so_far, before + _TEXT_AT_ONCE, side="right")))
        part = batch.slice(first, end - first)
        yield from zip(part.column(0).to_pylist(), encoder.ids(part.column(1)))
        first = end


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


# One row of a round. kind: placed (number of the sequence in seq, order of placing in place), item (not placed) or gap.
# place is also the rank of an item or of a gap in its range, by size.
SWEPT = "part int, kind string, id long, size int, seq long, place long"


def _fit(rows: Iterator[tuple[int, int, int]]) -> tuple[list, list, list]:
    """Best fit of (1 for a document, size, id) and gaps (0, size, sequence), largest first, gaps before documents of the same size.

    Gives (document, size, sequence, order) of what is placed, (document, size) of what is not, and (sequence, size) of the gaps
    that are left, largest first.
    """
    at_size: dict[int, list[int]] = {}
    open_sizes = 0  # bit s is set while there is a gap of size s
    placed, items = [], []
    for is_item, size, id_ in rows:
        if not is_item:
            at_size.setdefault(size, []).append(id_)
            open_sizes |= 1 << size
            continue
        fitting = open_sizes >> size
        if not fitting:
            items.append((id_, size))
            continue
        gap = size + (fitting & -fitting).bit_length() - 1
        row = at_size[gap]
        seq = row.pop()
        if not row:
            open_sizes &= ~(1 << gap)
        placed.append((id_, size, seq, len(placed)))
        if gap > size:
            at_size.setdefault(gap - size, []).append(seq)
            open_sizes |= 1 << (gap - size)
    return placed, items, [(seq, size) for size in sorted(at_size, reverse=True) for seq in at_size[size]]


def _swept(part: int, placed: list, items: list, gaps: list) -> Iterator[pa.RecordBatch]:
    for kind, rows in (
        ("placed", placed),
        ("item", [(i, size, None, rank) for rank, (i, size) in enumerate(items)]),
        ("gap", [(None, size, seq, rank) for rank, (seq, size) in enumerate(gaps)]),
    ):
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array([kind] * len(rows), pa.string()),
                    *(pa.array(column, kind_) for column, kind_ in zip(zip(*rows), kinds)),
                ],
                ["part", "kind", "id", "size", "seq", "place"],
            )


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best fit within one range. Rows come by size, largest first, gaps before documents of the same size."""
    rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3))))
    yield from _swept(TaskContext.get().partitionId(), *_fit(rows))


def _sweep_dealt(capacity: int):
    """Best fit of one range of documents of all sizes, in as many new sequences as they fill."""

    def sweep(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        table = table.sort_by([("size", "descending"), ("id", "ascending")])
        sizes, ids = table.column("size").to_pylist(), table.column("id").to_pylist()
        first = part << 32
        fresh = [(0, capacity, 2 * (first + i)) for i in range(sum(sizes) // capacity)]
        out = list(_swept(part, *_fit([*fresh, *((1, size, id_) for size, id_ in zip(sizes, ids))])))
        return pa.Table.from_batches(out)

    return sweep


# Documents first to last of a range (by rank) go to gaps of another, ``each`` to a gap, from the gap ``top`` down.
Match = namedtuple("Match", "part first last gap_part top each turn")


def _across(items: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]]) -> list[Match]:
    """Best fit between ranges. items and gaps: (range, size, number of this size), the ranks of a range being by size.

    Documents of one size and range are taken together, largest first, and so are gaps (runs of ranks). What a run
    keeps after a match is offered again.
    """
    runs, ranked = [], Counter()
    for part, size, n in sorted(gaps, key=lambda g: -g[1]):
        runs.append((size, part, ranked[part], ranked[part] + n - 1))
        ranked[part] += n
    runs.sort()
    ranked.clear()
    out: list[Match] = []
    for part, size, n in sorted(items, key=lambda i: (-i[1], i[0])):
        first = ranked[part]
        ranked[part] += n
        while first < ranked[part]:
            at = bisect_left(runs, (size,))
            if at == len(runs):
                break
            gap, gap_part, low, high = runs.pop(at)
            each, left = gap // size, ranked[part] - first
            used = min(high - low + 1, -(-left // each))
            taken = min(left, used * each)
            out.append(Match(part, first, first + taken - 1, gap_part, high, each, len(out)))
            first += taken
            in_last = taken - (used - 1) * each
            for kept, a, b in (
                (gap, low, high - used),
                (gap - in_last * size, high - used + 1, high - used + 1),
                (gap - each * size, high - used + 2, high),
            ):
                if kept > 0 and a <= b:
                    insort(runs, (kept, gap_part, a, b))
    return out


SENT = "id long, size int, gap_part int, rank long, place long, sent boolean"


def _send(batches: Iterator[pa.RecordBatch], matches: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Items (part, id, size, place) with their gap's range and rank, as far as there is one for them."""
    for batch in batches:
        part, id_, size, place = (batch.column(i).to_numpy() for i in range(4))
        gap_part, rank, turn = np.full((3, len(part)), -1, np.int64)
        for own in np.unique(part):
            if own not in matches:
                continue
            at = np.flatnonzero(part == own)
            table = matches[own]  # columns of Match without part, by first
            row = np.searchsorted(table[:, 0], place[at], side="right") - 1
            inside = (row >= 0) & (place[at] <= table[row, 1])
            at, table = at[inside], table[row[inside]]
            order = place[at] - table[:, 0]
            gap_part[at], rank[at] = table[:, 2], table[:, 3] - order // table[:, 4]
            turn[at] = (table[:, 5] + 1 << 12) + order % table[:, 4] + (1 << 40)  # after all that the sweep placed
        columns = [id_, size, gap_part.astype(np.int32), rank, turn, gap_part >= 0]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "size", "gap_part", "rank", "place", "sent"])


def best_fit(items: DataFrame, capacity: int = CAPACITY, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(id, seq, offset) for ``items`` (id long, unique; size int from 1 to ``capacity``): sequences of at most
    ``capacity`` without gaps between their items. Read ``items`` from a table: it is read twice. Empty: no rows.
    """
    spark = items.sparkSession
    whole = items.filter(F.col("size") == capacity).select(
        "id", (F.col("id") * 2 + 1).alias("seq"), F.lit(0).alias("round"), F.lit(0).cast("long").alias("place"), "size"
    )
    left = items.filter(F.col("size") < capacity).select("id", "size")
    ranges = max(1, math.ceil(left.count() / rows_per_range))
    dealt = left.select(F.pmod(F.xxhash64("id"), F.lit(ranges)).cast("int").alias("deal"), "id", "size").groupBy("deal")
    swept = staged(dealt.applyInArrow(_sweep_dealt(capacity), SWEPT), "packing-dealt")
    placed = [whole, swept.filter("kind = 'placed'").select("id", "seq", F.lit(1).alias("round"), "place", "size")]
    is_item = F.col("kind") == "item"
    total = swept.agg(
        F.count(F.when(F.col("kind") == "placed", 1)).alias("placed"),
        F.count(F.when(is_item, 1)).alias("n"),
        F.coalesce(F.sum(F.when(is_item, F.col("size"))), F.lit(0)).alias("size"),
        F.min(F.when(is_item, F.col("size"))).alias("least"),
    ).first()
    n_items, wanted = total["n"], total["size"]
    log.info("round 1: %d range(s), sweeps placed %d of %d document(s)", ranges, total["placed"], total["placed"] + n_items)
    left = swept.filter(is_item).select("id", "size")
    # Gaps smaller than all that is left stay as they are.
    gaps = swept.filter((F.col("kind") == "gap") & (F.col("size") >= (total["least"] or capacity))).select("seq", "size")
    n_gaps = gaps.count() if n_items else 0
    opened, round_ = ranges << 32, 1
    while n_items:
        round_ += 1
        # After the second round, the gaps of the last one hold none of what is left.
        more = math.ceil(wanted / capacity)
        fresh = spark.range(opened, opened + more).select((F.col("id") * 2).alias("seq"), F.lit(capacity).alias("size"))
        gaps, n_gaps, opened = gaps.unionByName(fresh), n_gaps + more, opened + more
        rows = left.select(F.lit(1).alias("kind"), "size", "id").unionByName(
            gaps.select(F.lit(0).alias("kind"), "size", F.col("seq").alias("id"))
        )
        ranges = math.ceil((n_items + n_gaps) / rows_per_range)
        order = [F.desc("size"), F.asc("kind"), F.xxhash64("id").asc(), F.asc("id")]
        by_size = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        swept = staged(by_size.mapInArrow(_sweep, SWEPT), f"packing-{round_}")
        # At most 2 * (capacity + ranges) + ranges rows.
        counts = swept.groupBy("part", "kind", F.when(F.col("kind") != "placed", F.col("size")).alias("size"))
        counts = counts.agg(F.count("*").alias("n")).collect()
        items_left = [(r["part"], r["size"], r["n"]) for r in counts if r["kind"] == "item"]
        gaps_left = [(r["part"], r["size"], r["n"]) for r in counts if r["kind"] == "gap"]
        n_items, wanted = sum(n for _, _, n in items_left), sum(size * n for _, size, n in items_left)
        n_gaps = sum(n for _, _, n in gaps_left)
        placed.append(
            swept.filter("kind = 'placed'").select("id", "seq", F.lit(round_).alias("round"), "place", "size")
        )
        left, gaps = swept.filter("kind = 'item'"), swept.filter("kind = 'gap'")
        matches = _across(items_left, gaps_left)
        moved = sum(m.last - m.first + 1 for m in matches)
        by_sweeps = sum(r["n"] for r in counts if r["kind"] == "placed")
        log.info("round %d: %d range(s), sweeps placed %d document(s), %d went across, %d left", round_, ranges, by_sweeps, moved, n_items - moved)
        if matches:
            by_part: dict[int, list] = {}
            for match in matches:
                by_part.setdefault(match.part, []).append(match[1:])
            table = {part: np.array(sorted(rows), np.int64) for part, rows in by_part.items()}
            the_matches = shared(spark, table)

            def sent(batches: Iterator[pa.RecordBatch], table=the_matches) -> Iterator[pa.RecordBatch]:
                yield from _send(batches, table())

            left = staged(left.select("part", "id", "size", "place").mapInArrow(sent, SENT), f"packing-{round_}-across")
            at = gaps.select(F.col("part").alias("gap_part"), F.col("place").alias("rank"), "seq")
            across = left.filter("sent").join(at, ["gap_part", "rank"])
            placed.append(across.select("id", "seq", F.lit(round_).alias("round"), "place", "size"))
            used = left.filter("sent").groupBy("gap_part", "rank").agg(F.sum("size").alias("used"))
            used = used.withColumnsRenamed({"gap_part": "part", "rank": "place"})
            gaps = gaps.join(used, ["part", "place"], "left").select(
                "seq", (F.col("size") - F.coalesce("used", F.lit(0))).cast("int").alias("size")
            )
            size_of = left.filter("sent").agg(F.sum("size")).first()[0]
            n_items, wanted = n_items - moved, wanted - size_of
            left = left.filter("not sent")
        left, gaps = left.select("id", "size"), gaps.select("seq", "size").filter("size > 0")
    rows = placed[0]
    for part in placed[1:]:
        rows = rows.unionByName(part)
    # A sequence has at most ``capacity`` items.
    before = Window.partitionBy("seq").orderBy("round", "place").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("offset")
    return rows.select("id", "seq", offset)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of ``docs`` (doc_id, text) with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ids_crc32 is the digest of the piece's ids as ``pieces`` gives them; ``packed`` gives the sequences themselves.
    Null and empty texts are packed as their end id. Repeated rows are packed each; an empty table gives no rows.
    """
    cut = pieces(docs, path, capacity).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    cut = staged(cut.withColumn("id", F.monotonically_increasing_id()), "pieces")
    placed = best_fit(cut.select("id", F.col("length").cast("int").alias("size")), capacity)
    return cut.join(placed, "id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset"
    )


def packed(docs: DataFrame, placed: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the sequences that ``pack`` planned, as little-endian 32-bit ids. doc_id must be unique."""
    rows = pieces(docs, path, capacity).join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` ids together
    joined = rows.groupBy("sequence_id").agg(in_order.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    return joined.select("sequence_id", ids.alias("ids"))


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"))
