import math
import random
import re
from collections import Counter

import duckdb
import pytest

from tallyhouse.llm import lexical_search as S

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = sorted(tuple(r) for r in S.op12_ranked_lexical_search(spark, folder).select("item_id", "rank", "doc_id", "score").collect())
    assert got == sorted(con.execute(f"SELECT item_id, rank, doc_id, score FROM ({S.ORACLE})").fetchall())
    assert got


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, nearest=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, wanted in asked.items():
        scores = []
        for place, (doc_id, c) in enumerate(counted):
            m = 10 + 90 * sum(c.values()) * n // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, place))
        for rank, (score, unnamed, doc_id, _) in enumerate(sorted(scores)[:nearest], 1):
            out.append((item_id, rank, None if unnamed else doc_id, -score))
    return sorted(out, key=str)


def made(rng, n, words):
    return " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=n))


@pytest.mark.parametrize("settings", [{}, {"block_docs": 5, "bundle_items": 2}, {"block_docs": 7, "vocabulary_terms": 0, "nearest": 3}])
def test_equals_brute_force(spark, settings):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["É", "Ünder", "日本", "X9"]
    docs = [(rng.choice([None, *range(40)]), made(rng, rng.randrange(30), words)) for _ in range(120)]
    docs += docs[:15] + [(99, None), (98, ""), (97, "- , ."), (96, "w1 " * 20_000 + "W2"), (95, "a\x00b\x7fc İ")]
    items = [(rng.choice([None, *range(12)]), made(rng, rng.randrange(12), words)) for _ in range(20)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "w1 W1 w1"), items[0], (54, "B c İ")]
    got = S.search(
        spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS + ", term string, block string").repartition(3),
        spark.createDataFrame([(*i, 0) for i in items], ITEMS + ", score int"), **settings,
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(docs, items, settings.get("nearest", 10))


def test_later_owners_are_pruned(spark, monkeypatch):
    """What cannot reach the best any more is not carried on, and the result stays that of brute force."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    items = [(i, made(rng, 12, words)) for i in range(6)]
    docs = [(i, made(rng, 25, words)) for i in range(600)] + [(1000 + i, items[i % 6][1]) for i in range(72)]
    sent, write = [], S.staged

    def counting(df, name):
        table = write(df, name)
        if name.startswith("search-owner"):
            sent.append(sum(len(r["docs"]) // 2 for r in table.select("docs").collect()))
        return table

    monkeypatch.setattr(S, "staged", counting)
    got = S.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_docs=64)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(docs, items)
    assert sent[-1] < 6 * len(docs) / 4


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")]), ([(1, "b")], [(1, "a")])])
def test_without_rows(spark, docs, items):
    assert S.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect() == []


def test_block_size_is_checked(spark):
    with pytest.raises(ValueError):
        S.index(spark.createDataFrame([], DOCS), spark.createDataFrame([], "term string"), block_docs=70_000)
