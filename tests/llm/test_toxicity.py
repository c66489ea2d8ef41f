import random
import zlib

import numpy as np
import pytest

from tallyhouse.llm import toxicity as T


def auc(scores, labels):
    pairs = [(s > t) + 0.5 * (s == t) for s, y in zip(scores, labels) if y for t, z in zip(scores, labels) if not z]
    return sum(pairs) / len(pairs)


def test_held_out_rows(spark, folder):
    got = {r["doc_id"]: r for r in T.op8_toxicity(spark, folder).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held_out = [i for i in labels if got[i]["held_out"]]
    assert auc([got[i]["score"] for i in held_out], [labels[i] for i in held_out]) > 0.85
    for row in got.values():
        assert all(zlib.crc32(str(e["doc_id"]).encode()) % 5 for e in row["evidence"])


def random_index(seed, examples=400, terms=30, k=9):
    rng = random.Random(seed)
    names = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(terms)]
    rows = []
    for i in range(examples):
        counts = {rng.choice(names): rng.randint(1, 4) for _ in range(rng.randint(0, 4))}
        rows.append((i, int("taa" in counts or "tab" in counts), counts))
    return T.ToxicityIndex(names, rows, {0: 3.0, 1: 1.0}, k), rows, names


def test_nearest_are_exact():
    index, rows, names = random_index(1)
    rng = random.Random(2)

    def dense(counts):
        v = np.zeros(len(names))
        for t, w in index.vector(counts):
            v[t] = w
        return v

    matrix = np.array([dense(c) for _, _, c in rows])
    for _ in range(200):
        counts = {rng.choice(names): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        cosine = matrix @ dense(counts)
        want = sorted(((-round(c, 12), i) for i, c in enumerate(cosine) if c > 1e-12))[:9]
        assert index.nearest(index.vector(counts)) == [(-c, i) for c, i in want]


def test_calibrated_scores_follow_the_votes():
    index, rows, _ = random_index(3)
    assert index.score("taa taa tac")[0] > 0.5 > index.score("taf")[0]
    assert index.score("nothing known")[0] == index.none < 0.5
    evidence = index.score("taa")[1]
    assert evidence and all(c > 0 for _, c, _ in evidence) and len(evidence) <= 9
    assert index.slope >= 0


def test_copies_do_not_make_a_word_telling(spark, make):
    rng = random.Random(4)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows, labels = [], []
    for i in range(300):
        text = rng.choices(words, k=40)
        if i % 5 == 0:
            text[7] = "insultly"
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    rare = " ".join(rng.choices(words, k=10)) + " rarething " + " ".join(rng.choices(words, k=10))
    for i in range(300, 360):
        rows.append((i, f"{rare} {rng.choice(words)}"))
        labels.append((i, 1))
    index = T.fit(make(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "insultly" in index.number and "rarething" not in index.number
    assert index.score("some insultly here")[0] > 0.5 > index.score("rarething")[0]


def test_rare_words_find_their_example(spark, make):
    """Each toxic text has an insult of its own: none tells the labels apart on the sample, but its copies are toxic."""
    rng = random.Random(6)
    name = lambda kind, i: f"{kind}{chr(97 + i % 26)}{chr(97 + i // 26)}"
    words = [name("word", i) for i in range(200)]
    slurs = ["".join(rng.choices("bcdfghjklm", k=8)) for _ in range(60)]  # no common beginnings either
    rows = [(i, " ".join([*rng.choices(words, k=30), *([slurs[i // 5]] * 2 if i % 5 == 0 else [])])) for i in range(300)]
    index = T.fit(make(rows), spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    assert not index.number
    for i, text in rows:
        score, evidence = index.score(text)
        assert (score >= 0.5) == (i % 5 == 0)
        assert evidence[0][0] == i and evidence[0][1] == pytest.approx(1) and evidence[0][2] == (i % 5 == 0)
    near = rows[50][1].split()
    near[3] = near[17] = "other"
    assert index.score(" ".join(near))[0] >= 0.5
    assert index.score("nothing known")[0] == index.none < 0.5


@pytest.mark.parametrize("common", [0, 30, 512])
def test_blocks_are_skipped_and_nothing_is_lost(monkeypatch, common):
    """Against dense cosines from the raw counts, with examples in several groups of like ones: most blocks are never added up."""
    monkeypatch.setattr(T, "HEAD_TERMS", common)
    rng = random.Random(8)
    groups = [[f"w{g}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80)] for g in range(20)]
    words = [w for group in groups for w in group] + ["common"]
    rows = [(i, i % 2, {w: rng.randint(1, 3) for w in rng.sample(groups[i % 20], 12)} | {"common": 1}) for i in range(2_000)]
    index = T.ToxicityIndex([], rows, {0: 1.0, 1: 1.0}, 10, words)
    df = {w: sum(w in c for _, _, c in rows) for w in words}

    def vector(counts):
        v = np.array([(1 + np.log(counts[w])) * (np.log((1 + len(rows)) / (1 + df[w])) + 1) if w in counts else 0 for w in words])
        return v / np.sqrt((v**2).sum())

    matrix = np.array([vector(c) for _, _, c in rows])
    index.offered = index.visited = 0
    for i in range(60):
        counts = {w: rng.randint(1, 3) for w in rng.sample(groups[i % 20], 12)} | {"common": 2}
        cosine = matrix @ vector(counts)
        want = sorted((-round(c, 9), j) for j, c in enumerate(cosine))[:10]
        got = index.nearest(index.vector(counts))
        assert [(-round(c, 9), j) for c, j in got] == want
    assert index.offered == 60 * index.blocks and index.visited < index.offered / 3


def test_nearest_over_telling_and_other_words_are_exact():
    rng = random.Random(7)
    names, words = [f"t{c}" for c in "abcde"], [f"w{c}{d}" for c in "abcdef" for d in "abcdef"]
    rows = [(i, i % 2, {rng.choice(names + 9 * words): rng.randint(1, 3) for _ in range(8)}) for i in range(150)]
    index = T.ToxicityIndex(names, rows, {0: 2.0, 1: 1.0}, 7, words)
    dense = lambda v: np.bincount([t for t, _ in v], [w for _, w in v], len(names) + len(words))
    matrix = np.array([dense(index.vector(c)) for _, _, c in rows])
    assert np.allclose((matrix**2).sum(axis=1), 1)
    for i, _, counts in rows:
        cosine = matrix @ dense(index.vector(counts))
        want = sorted((-round(c, 12), j) for j, c in enumerate(cosine) if c > 1e-12 and j != i)[:7]
        got = index.nearest(index.vector(counts), without=i)
        assert [j for _, j in got] == [j for _, j in want] and np.allclose([c for c, _ in got], [-c for c, _ in want])


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 1)], [(99, 1)], [(1, 0), (2, 0)]])
def test_few_or_no_examples(spark, make, labels):
    index = T.fit(make([(1, "a b"), (2, None)]), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert 0 <= index.score("a b")[0] <= 1 and index.score(None) == index.score("")


def test_rows_columns_and_names(make):
    index, _, _ = random_index(5)
    df = make([(1, "taa Tab"), (1, "taa Tab"), (None, "taa"), (2, None), (3, ""), (4, "taa x " * 100_000)], extra=("score", "_toxicity", "evidence"))
    got = T.score_toxicity(df, index).collect()
    assert len(got) == 6 and {r["_toxicity"] for r in got} == {"x1"}
    assert {r["score"] for r in got if r["doc_id"] in (2, 3)} == {index.none}
    assert T.score_toxicity(df.limit(0), index).count() == 0


def test_repeated_labels_count_once(spark, make):
    index = T.fit(make([(1, "a"), (1, "a"), (2, "a"), (3, "b")]), spark.createDataFrame([(1, 0), (1, 1), (3, 0)], "doc_id long, toxic int"))
    assert sorted(zip(index.ids.tolist(), index.labels.tolist())) == [(1, 1.0), (3, 0.0)]
