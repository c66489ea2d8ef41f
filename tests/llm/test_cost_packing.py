import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import cost_packing as C

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(C.default_vocabulary())


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()


def check_sequences(rows, capacity=1024):
    """Gapless, and full or of a power of two; gives the sequences' sizes and costs."""
    by_sequence = defaultdict(list)
    for row in rows:
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    sizes = []
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end == capacity or (end < capacity and end & (end - 1) == 0)
        sizes.append((end, sum(C.cost(length) for _, length in places)))
    return sizes


def check_pieces(rows, ids_by_doc, value):
    """Each id of each document lies in exactly one piece."""
    by_doc = defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
    assert by_doc.keys() == ids_by_doc.keys()
    for doc_id, ids in ids_by_doc.items():
        end = 0
        for row in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert row["start"] == end and row["doc_tokens"] == len(ids) // 4
            end += row["length"]
            assert value(row) == (zlib.crc32(ids[4 * row["start"] : 4 * end]) if "ids_crc32" in row else ids[4 * row["start"] : 4 * end])
        assert 4 * end == len(ids)


def test_query_packs_every_id_without_padding(spark, folder, texts, library):
    rows = [r.asDict() for r in C.op13_cost_balanced_packing(spark, folder).collect()]
    ids = {doc_id: ids_of(library, text) for doc_id, text in texts.items()}
    check_pieces(rows, ids, lambda r: r["ids_crc32"])
    sizes = check_sequences(rows)
    total = sum(len(i) for i in ids.values()) // 4
    assert sum(n == 1024 for n, _ in sizes) == total // 1024 and len(sizes) <= total // 1024 + 10
    # A document is cut about once a sequence at most.
    assert len(rows) <= len(ids) + len(sizes)


ODD = [
    None, "", " ", "\n\n a", "<|endoftext|>", "x<|endoftext|> y  <|endoftext|>", "it's 12's x\x85\xa0y", "ab" * 30_000,
    "日本語 と é ǆ 😀‍👩 ́", "!!!??? 1a2b", " " * 300_000 + "x", "　" * 300_000,
]


def test_ids_are_the_librarys(library):
    with open(C.default_vocabulary(), encoding="utf-8") as file:
        encoder = C.ByteEncoder(file.read())
    rng = random.Random(7)
    signs = "ab Z9.'\n\t\xa0é日 😀<|>"
    for text in ODD + ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3_000)]:
        assert encoder.ids(text) + b"\0\0\0\0" == ids_of(library, text), text


def test_other_vocabularies_are_refused(library):
    with pytest.raises(ValueError):
        C.ByteEncoder(library.to_str().replace('"ByteLevel"', '"Whitespace"', 1).replace('"add_prefix_space":false', '"add_prefix_space":true'))


def greedy(sizes, capacities):
    """The rule as it is told: dearest first, to the cheapest sequence with room, cut where none has."""
    waiting = sorted(((-size, doc, 0) for doc, size in enumerate(sizes) if size))
    room, costs, out = list(capacities), [0] * len(capacities), []
    while waiting and any(room):
        size, doc, start = waiting.pop(0)
        size = -size
        fitting = [s for s in range(len(room)) if room[s] >= size]
        seq = min(fitting or [s for s in range(len(room)) if room[s]], key=lambda s: (costs[s], s))
        length = min(size, room[seq])
        out.append((doc, start, length, seq, capacities[seq] - room[seq]))
        room[seq] -= length
        costs[seq] += C.cost(length)
        if length < size:
            waiting.append((length - size, doc, start + length))
            waiting.sort()
    return out, [(doc, start, -size) for size, doc, start in waiting]


def test_deal_follows_the_rule():
    rng = random.Random(11)
    for _ in range(300):
        capacity = rng.choice([4, 16, 100])
        sizes = [rng.randrange(capacity) for _ in range(rng.randrange(60))]
        whole, rest = divmod(sum(sizes), capacity)
        capacities = [capacity] * whole + (C.powers_of_two(rest) if rng.random() < 0.5 else [])
        placed, left = C.deal(sizes, capacities)
        assert (placed, left) == greedy(sizes, capacities)
        assert sum(n for _, _, n in left) == sum(sizes) - sum(capacities)


def test_costs_are_balanced():
    """Whole sequences of short documents cost about the same; first come, first served does not."""
    rng = random.Random(2)
    sizes = [min(1023, int(rng.paretovariate(1.1) * 20)) for _ in range(5_000)]
    placed, _ = C.deal(sizes, [1024] * (sum(sizes) // 1024))
    costs = defaultdict(int)
    for _, _, length, seq, _ in placed:
        costs[seq] += C.cost(length)
    in_turn, own = [], []
    for size in sizes:
        own.append(size)
        if sum(own) >= 1024:
            in_turn.append(sum(map(C.cost, own)))
            own = []
    assert np.std(list(costs.values())) < 0.5 * np.std(in_turn)


def test_odd_rows_in_small_groups(spark, library, monkeypatch):
    monkeypatch.setattr(C, "GROUP_ROWS", 3)
    ids = {i: ids_of(library, text) for i, text in enumerate(ODD)}
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(ODD)], "doc_id long, text string, ids string, length int")
    rows = [r.asDict() for r in C.sequences(docs.repartition(4)).collect()]
    check_pieces(rows, ids, lambda r: bytes(r["ids"]))
    check_sequences(rows)
    for capacity in (1, 7):
        rows = [r.asDict() for r in C.pack(docs.filter("doc_id < 10 and doc_id != 7"), capacity=capacity).collect()]
        check_sequences(rows, capacity)


def test_repeated_rows_and_rows_without_id(spark, library):
    rows = [r.asDict() for r in C.pack(spark.createDataFrame([(1, "a b")] * 3 + [(None, None)] * 2, DOCS)).collect()]
    check_sequences(rows)
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 3 * len(ids_of(library, "a b")) // 4
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == 2


def test_empty_table(spark):
    assert C.pack(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        C.pack(spark.createDataFrame([], DOCS), capacity=0)
