import random
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np

from tallyhouse.llm import filter_audit as A

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = "doc_id long, quality int, toxic int"


def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = [tuple(r) for r in A.op11_filter_audit(spark, folder).select(*COLUMNS).collect()]
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({A.ORACLE})").fetchall()
    assert len(want) == 600 * len({r[0] for r in want})
    assert sorted(got) == sorted(want)


def test_carry_save_counts_are_positional_popcounts():
    rng = np.random.default_rng(5)
    for n_keys, n in ((1, 0), (1, 1), (1, 1000), (3, 2), (7, 500), (400, 1000)):
        keys = rng.integers(0, n_keys, n)
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        want = np.zeros((n_keys, 32), np.int64)
        for key, word in zip(keys, words):
            want[key] += [int(word) >> s & 1 for s in range(32)]
        assert (A.positional_popcounts(keys, words, n_keys) == want).all()


def fails_of(rows):
    """The filters that fail each (doc_id, text), by plain Python."""
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
        out.append({
            *("A" if len(words) < 200 else ""),
            *("B" if 100 * len(set(words)) < 50 * len(words) else ""),
            *("C" if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else ""),
            *("D" if set(text) & set("#$%&*|") else ""),
            *("E" if doc_id is not None and text in first and doc_id > first[text] else ""),
        })
    return out


def brute_force(rows, labels):
    labels = [label for label in labels if label[0] is not None]
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    out = []
    parts = defaultdict(list)
    for (doc_id, _, source), fails in zip(rows, fails_of(rows)):
        parts[source or ""].append((doc_id, fails))
    for part, members in parts.items():
        shapley, lines = Counter(), []
        for order in permutations("ABCDE"):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                failing = sum(letter in f for _, f in members)
                shapley[letter] += len(gone)
                lines.append((
                    part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(f == {letter} for _, f in members),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), letter,
                ))
        out += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return sorted(out)


def test_odd_rows_equal_brute_force(spark):
    rng = random.Random(3)
    clean = " ".join(f"w{i}" for i in range(220))
    texts = [None, "", " \t\n", clean, clean.replace(" ", "\x0b"), clean + " #", "A" * 40, "ein wort " * 150, clean.title() + " é x", "x " * 60_000]
    rows = [(rng.choice([None, *range(25)]), rng.choice(texts), rng.choice(["a", "", None])) for _ in range(90)]
    rows += rows[:10]
    labels = [(rng.choice([None, *range(25)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(40)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, source string, part string, word string")
    got = A.audit(docs, spark.createDataFrame(labels, LABELS))
    assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == brute_force(rows, labels)


def test_without_rows_or_labels(spark):
    docs = "doc_id long, text string, source string"
    none = spark.createDataFrame([], LABELS)
    assert A.audit(spark.createDataFrame([], docs), none).collect() == []
    got = A.audit(spark.createDataFrame([(1, "a", "s")], docs), none).collect()
    assert len(got) == 600 and not any(r["good_lost"] or r["toxic_lost"] for r in got)
    assert {(r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in got if r["filter_order"][r["step"] - 1] == "A"} == {(0, 1, 0, 1, 120)}
