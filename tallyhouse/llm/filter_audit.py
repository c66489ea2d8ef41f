"""How filters overlap: what each removes in every order of applying them, from truth-table survival words.

Every document becomes a word of 32 bits, one for each subset of five filters: bit S is set if the document survives
all filters of S. Filter i (of bit i in S) that fails it clears the bits of all subsets with i, which is one fixed mask,
so a word is -1 with a few masks applied. The words of a part and label are then counted by bit position with
carry-save adders: three words of a weight become one of that weight and one of twice the weight, until two at most are
left of each. What comes out, survivors of every subset, says everything about every order: a step keeps the survivors of the
filters up to it, and removes those of the filters before it less these.

The text filters are native expressions. A batch of words becomes one row of 32 counts for each part and label in it, which
Spark adds up, so a part of any size is never together in a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import read, staged

LETTERS = "ABCDE"
SUBSETS = 1 << len(LETTERS)
# Bit S of the mask of filter i is set where S is without i.
_WITHOUT = [sum(1 << s for s in range(SUBSETS) if not s >> i & 1) for i in range(len(LETTERS))]

LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 2
_SPACE = r"[\x20\x09-\x0D]+"
_MARK = "[#$%&*|]"


def failing(texts: DataFrame) -> DataFrame:
    """``texts`` (with a column text that is never null) and whether each row fails A to D, as a struct of these names."""
    # The words are a column first, so that they are cut once.
    words = texts.withColumn("words", F.filter(F.split("text", _SPACE), lambda w: w != ""))
    counted = words.withColumns({"n": F.size("words"), "n_distinct": F.size(F.array_distinct("words"))}).drop("words")
    fails = {
        "A": F.col("n") < LEAST_WORDS,
        "B": 100 * F.col("n_distinct") < LEAST_DISTINCT_PERCENT * F.col("n"),
        "C": 100 * F.regexp_count("text", F.lit("[A-Z]")) > MOST_CAPITAL_PERCENT * F.length("text"),
        "D": F.col("text").rlike(_MARK),
    }
    return counted.select(*texts.columns, F.struct(*(f.alias(letter) for letter, f in fails.items())).alias("fails"))


def _without(word: Column, fails: Column, filter_: int) -> Column:
    return F.when(fails, word.bitwiseAND(F.lit(_WITHOUT[filter_]).cast("int"))).otherwise(word)


def survival_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, label, word) of every row of ``docs``: label is 1 for good plus 2 for toxic.

    A copy of a smaller doc_id's text fails E, so of equal texts those of the smallest id pass, and so do rows without
    id. A document is good (toxic) if any row of ``labels`` with its id says so. Null texts and sources are empty ones.
    """
    texts = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    )
    word = F.lit(-1)
    for i, letter in enumerate(LETTERS[:-1]):
        word = _without(word, F.col(f"fails.{letter}"), i)
    facts = failing(texts).select("doc_id", "part", word.alias("word"), F.unhex(F.sha2("text", 256)).alias("digest"))
    facts = staged(facts, "filter-facts")
    # Both tables are written before they are joined: adaptive execution can then split what a key with very many rows gets.
    copied = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    copied = staged(copied.filter("rows > 1").select("digest", "first"), "filter-copied")
    said = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"),
    )
    said = staged(said.select("doc_id", (F.col("good") + 2 * F.col("toxic")).alias("label"), F.lit(0).alias("spread")), "filter-labels")
    # Rows without id meet no label; they are spread so that they do not meet each other either.
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id() % 997).otherwise(0).cast("int")
    rows = facts.withColumn("spread", spread).join(said, ["doc_id", "spread"], "left").join(copied, "digest", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.select("part", F.coalesce("label", F.lit(0)).alias("label"), _without(F.col("word"), copy, 4).alias("word"))


def positional_popcounts(keys: np.ndarray, words: np.ndarray, n_keys: int) -> np.ndarray:
    """For each key (0 to ``n_keys`` - 1) and bit, how many of its words have the bit. Carry-save addition of all keys at once."""
    counts = np.zeros((n_keys, SUBSETS), np.int64)
    weight = 1
    while len(words):
        carried_keys, carried = [], []
        while True:
            order = np.argsort(keys, kind="stable")
            keys, words = keys[order], words[order]
            n = np.bincount(keys, minlength=n_keys)
            place = np.arange(len(keys)) - (np.cumsum(n) - n)[keys]
            in_three = place < (n // 3 * 3)[keys]
            if not in_three.any():
                break
            a, b, c = words[in_three].reshape(-1, 3).T
            differ = a ^ b
            of = keys[in_three][::3]
            carried_keys.append(of)
            carried.append((a & b) | (c & differ))
            keys, words = np.concatenate([of, keys[~in_three]]), np.concatenate([differ ^ c, words[~in_three]])
        bits = (words[:, None] >> np.arange(SUBSETS, dtype=np.uint32)) & 1
        np.add.at(counts, keys, bits.astype(np.int64) * weight)
        keys, words = (np.concatenate(x) if x else np.zeros(0, np.uint32) for x in (carried_keys, carried))
        weight *= 2
    return counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(0).dictionary_encode()
        label = batch.column(1).to_numpy().astype(np.int64)
        both, keys = np.unique(part.indices.to_numpy().astype(np.int64) * 4 + label, return_inverse=True)
        counts = positional_popcounts(keys, batch.column(2).to_numpy().view(np.uint32), len(both))
        yield pa.RecordBatch.from_arrays(
            [pc.take(part.dictionary, pa.array(both // 4)), pa.array((both % 4).astype(np.int32)), *map(pa.array, counts.T)],
            ["part", "label", *(f"s{s}" for s in range(SUBSETS))],
        )


def survivors(words: DataFrame) -> DataFrame:
    """(part, all, good, toxic): for each part the survivors of every subset, as arrays by subset number."""
    each = [f"s{s}" for s in range(SUBSETS)]
    counted = words.mapInArrow(_counted, ", ".join(["part string", "label int", *(f"{s} long" for s in each)]))
    kinds = {"all": F.lit(True), "good": F.col("label").bitwiseAND(1) > 0, "toxic": F.col("label").bitwiseAND(2) > 0}
    sums = [F.sum(F.when(is_, F.col(s)).otherwise(0)).alias(f"{kind}_{s}") for kind, is_ in kinds.items() for s in each]
    summed = counted.groupBy("part").agg(*sums)
    return summed.select("part", *(F.array(*(f"{kind}_{s}" for s in each)).alias(kind) for kind in kinds))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of that step's filter within the part.

    docs: doc_id, text, source; labels: doc_id, quality, toxic. Further columns are not read. Repeated rows count each;
    equal ids with equal texts pass E together. An empty text fails A only. Very long texts are counted whole.
    No documents: no rows. Documents without labels: good_lost and toxic_lost are 0.
    """
    return interactions(survivors(survival_words(docs, labels)))


def interactions(counts: DataFrame) -> DataFrame:
    """Every order and step from the survivors of the subsets (``survivors``): a fixed table of 600 rows for each part."""
    n = len(LETTERS)
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, filter_ in enumerate(order, 1):
            steps.append(("".join(LETTERS[i] for i in order), step, before, filter_))
            before |= 1 << filter_
    names, numbers, befores, filters = (F.expr(f"array({', '.join(map(repr, column))})") for column in zip(*steps))
    factorial = [1, 1, 2, 6, 24]
    shapley = F.array(
        *(
            sum(
                factorial[size] * factorial[n - 1 - size] * (F.col("all")[s] - F.col("all")[s | 1 << i])
                for s in range(SUBSETS)
                if not s >> i & 1
                for size in [s.bit_count()]
            )
            for i in range(n)
        )
    )
    rows = counts.select("part", "all", "good", "toxic", shapley.alias("each_shapley"), F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("at"))
    rows = rows.select(
        "*", names[F.col("at")].alias("filter_order"), numbers[F.col("at")].cast("int").alias("step"),
        befores[F.col("at")].alias("before"), filters[F.col("at")].alias("filter"),
    )
    own = F.element_at(F.lit([1 << i for i in range(n)]), F.col("filter") + 1)
    rows = rows.withColumn("own", own).withColumn("after", F.col("before") + F.col("own"))
    all_, good, toxic = F.col("all"), F.col("good"), F.col("toxic")
    before, after, own = F.col("before"), F.col("after"), F.col("own")
    removed = all_[before] - all_[after]
    return rows.select(
        "part", "filter_order", "step",
        all_[after].alias("kept"),
        removed.alias("removed"),
        (all_[0] - all_[own] - removed).alias("redundant"),
        (all_[F.lit(SUBSETS - 1) - own] - all_[SUBSETS - 1]).alias("unique_fails"),
        (good[before] - good[after]).alias("good_lost"),
        (toxic[before] - toxic[after]).alias("toxic_lost"),
        F.col("each_shapley")[F.col("filter")].alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


_WORDS_SQL = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
_FAILS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 2 * n_chars",
    "D": "marked",
    "E": "doc_id > first_id",
}
ORACLE = f"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), measured AS (
    SELECT doc_id, part, len({_WORDS_SQL}) AS n_words, len(list_distinct({_WORDS_SQL})) AS n_distinct,
        len(regexp_extract_all(text, '[A-Z]')) AS n_capitals, length(text) AS n_chars,
        regexp_matches(text, '[#$%&*|]') AS marked, min(doc_id) OVER (PARTITION BY text) AS first_id
    FROM texts
), said AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failed AS (
    SELECT part, {' + '.join(f"CASE WHEN {sql} THEN {1 << i} ELSE 0 END" for i, sql in enumerate(_FAILS.values()))} AS fails,
        count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
    FROM measured LEFT JOIN said USING (doc_id) GROUP BY ALL
), letter(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT filter_order, step, (1 << (ascii(filter_order[step]) - 65))::BIGINT AS own,
        coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::BIGINT AS before
    FROM orders, range(1, 6) t(step)
), counted AS (
    SELECT part, filter_order, step, own,
        sum(n) FILTER (fails & (before | own) = 0) AS kept,
        sum(n) FILTER (fails & before = 0 AND fails & own > 0) AS removed,
        sum(n) FILTER (fails & before > 0 AND fails & own > 0) AS redundant,
        sum(n) FILTER (fails = own) AS unique_fails,
        sum(n_good) FILTER (fails & before = 0 AND fails & own > 0) AS good_lost,
        sum(n_toxic) FILTER (fails & before = 0 AND fails & own > 0) AS toxic_lost
    FROM failed, steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""
