import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tallyhouse.llm import simhash as S
from test_common import brute_components


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(texts):
    """component_id by doc_id."""
    bits = {i: brute_fingerprint(t) for i, t in texts.items()}
    by_bits = {}
    for i in sorted(bits):
        by_bits.setdefault(bits[i], []).append(i)
    links = [(ids[0], i) for ids in by_bits.values() for i in ids]
    firsts = np.array(list(by_bits), np.uint64)
    for k, value in enumerate(firsts):
        near = np.flatnonzero(np.bitwise_count(firsts[k + 1 :] ^ value) <= 4) + k + 1
        links += [(by_bits[int(value)][0], by_bits[int(firsts[j])][0]) for j in near]
    return bits, brute_components(links)


def test_query_equals_brute_force(spark, folder, texts):
    bits, groups = brute_groups(texts)
    got = {r["doc_id"]: r for r in S.op9_simhash_near_dedup(spark, folder).collect()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{b:016x}" for i, b in bits.items()}
    assert {i: r["component_id"] for i, r in got.items()} == groups


def test_fingerprints_of_odd_texts():
    for text in (None, "", " \t\n", "one", "A b c", "a b c d", "a\x1cb\x85 c\xa0d É", "x y " * 70_000, "Ä Ö Ü A B"):
        assert S.fingerprint(text) == brute_fingerprint(text)


def near_fingerprints(seed, n):
    rng = random.Random(seed)
    points = {0, (1 << 64) - 1}
    while len(points) < n:
        base = rng.choice(sorted(points)) if rng.random() < 0.7 else rng.getrandbits(64)
        points.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    return sorted(points)


@pytest.mark.parametrize("block_rows", [8_192, 40])
def test_links_connect_exactly_what_is_near(spark, block_rows):
    points = near_fingerprints(block_rows, 400)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    found = S.similar_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), block_rows=block_rows)
    links = {(r["a"], r["b"]) for r in found.collect()}
    near = [(a, b) for (a, x), (b, y) in combinations(zip(signed, points), 2) if (x ^ y).bit_count() <= 4]
    assert links and all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in links)
    assert brute_components(links) == brute_components(near)


def test_points_within_four_share_a_cell():
    rng = random.Random(2)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << bit for bit in rng.sample(range(64), 4))
        rows, cells = S.cells(np.array([a, b], np.uint64))
        assert set(cells[rows == 0]) & set(cells[rows == 1])


ROWS = [(3, "a b c d e f"), (1, "A B C D E F"), (1, "A B C D E F"), (2, None), (5, ""), (None, " "), (None, "other words here at all"), (9, "long " * 100_000)]


def test_rows_columns_and_names(make):
    df = make(ROWS, extra=("fp", "class", "row_hash", "_key"))
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in S.near_duplicates(df).collect())
    assert got == [(-1, -1), (-1, 2), (1, 1), (1, 1), (2, 2), (3, 1), (5, 2), (9, 9)]
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_one_of_each_group(make, docs, texts):
    df = make(ROWS, extra=("fp", "class", "row_hash", "_key"))
    kept = S.one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or -1, r["_key"]) for r in kept.collect()) == [(-1, "x3"), (1, "x3"), (2, "x3"), (9, "x3")]
    assert S.one_of_each_group(df.limit(0)).count() == 0
    groups = brute_groups(texts)[1]
    assert {r["doc_id"] for r in S.one_of_each_group(docs).collect()} == {i for i, c in groups.items() if i == c}


def test_more_than_four_bits_are_refused(spark):
    with pytest.raises(ValueError, match="4 differing bits"):
        S.similar_fingerprints(spark.createDataFrame([(1,)], "fp long"), max_bits=5)
