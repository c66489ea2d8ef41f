import random

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import common as C


def brute_components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize(
    "pairs",
    [
        [],
        [(5, 5)],
        [(i, i + 1) for i in range(40)],
        [(0, i) for i in range(1, 60)] + [(100 + i, 99) for i in range(20)],
        [(random.Random(i).randint(-50, 50), random.Random(i + 900).randint(-50, 50)) for i in range(70)],
    ],
    ids=["none", "self", "chain", "stars", "random"],
)
def test_components(spark, pairs):
    edges = spark.createDataFrame([*pairs, *pairs[:3]], "a long, b long")
    got = {r["node"]: r["component"] for r in C.components(edges).collect()}
    assert got == brute_components([p for p in pairs if p[0] != p[1]])


@pytest.mark.parametrize("limit", [1, 3, 100])
def test_sorted_groups_are_whole_or_large(limit):
    rng = random.Random(limit)
    keys = sorted(rng.choice([-4, 0, 0, 0, 7, 9, 9, 12, 30, 31]) for _ in range(60))
    values = list(range(60))
    cuts = sorted({0, 60, *(rng.randint(0, 60) for _ in range(9))})
    batches = [
        pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.int64()), pa.array(values[a:b], pa.int64())], ["k", "v"])
        for a, b in zip(cuts, cuts[1:])
    ]
    whole, large = {}, {}
    for rows, starts, is_large in C.sorted_groups(batches, "k", limit):
        k, v = rows.column("k").to_pylist(), rows.column("v").to_pylist()
        for a, b in zip(starts, [*starts[1:], len(k)]):
            assert len(set(k[a:b])) == 1
            if is_large:
                large.setdefault(k[a], []).extend(v[a:b])
            else:
                assert k[a] not in whole
                whole[k[a]] = v[a:b]
    want = {}
    for k, v in zip(keys, values):
        want.setdefault(k, []).append(v)
    assert whole == {k: v for k, v in want.items() if len(v) <= limit}
    assert large == {k: v for k, v in want.items() if len(v) > limit}


def test_any_two_rows_of_a_key_meet_once(spark):
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 23), (2, 5), (3, 1)) for i in range(n)], "k long, v long")
    groups = {}
    for r in C.block_pairs(rows, "k", "v", block_rows=4).collect():
        groups.setdefault(r["pair"], []).append(r)
    met = {}
    for group in groups.values():
        assert len({r["k"] for r in group}) == 1
        for a in group:
            for b in group:
                if a["v"] < b["v"] and (a["alone"] or a["side"] != b["side"]):
                    met[a["k"], a["v"], b["v"]] = met.get((a["k"], a["v"], b["v"]), 0) + 1
    want = {(k, a, b) for k, n in ((1, 23), (2, 5)) for a in range(n) for b in range(a + 1, n)}
    assert met == dict.fromkeys(want, 1)


def test_spanning_links_connect_what_is_near():
    points = np.array([0, 10, 1, 2, 11, 30])
    links = C.spanning_links(len(points), lambda i, others: np.abs(points[others] - points[i]) <= 1)
    assert brute_components(links) == {0: 0, 2: 0, 3: 0, 1: 1, 4: 1}


def test_memo_forgets_and_recomputes():
    calls = []
    memo = C.Memo(lambda key: calls.append(key) or len(key), entries=2)
    words = ["a", "bb", "ccc", "a", "dddd", "bb", "x" * 100, "x" * 100]
    assert [memo[w] for w in words] == list(map(len, words))
    assert calls.count("x" * 100) == 2 and len(memo) <= 2


def test_free_name(spark):
    df = spark.createDataFrame([(1, 2)], "_x long, `_X_` long")
    assert C.free_name(df, "_x") == "_x__"
