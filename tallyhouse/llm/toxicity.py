"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index of all their words.

All words of the examples are terms, so that an example is found by whatever it shares with a text. Some terms tell the
labels apart: words and word beginnings (of four to seven letters, which stand for inflected and joined forms) that pass
a chi-square test and a ratio of shares on the sample. An occurrence of a word is counted there by its neighbours to
the left and right, once for each pair of them, so copies of a text do not make its rare words look telling. A vector
has two parts, of telling terms and of all other words, each by TF-IDF; the other words together weigh ``REST`` times
what the telling terms do, and all there is in texts without telling terms. A copy of an example has cosine 1 either way.

The index keeps the examples in blocks of ``BLOCK``, like ones together. For each term and block that has it there is the
greatest weight, and the list of the block's examples with their weights. A text's terms and those greatest weights give an upper bound
for every block; blocks are visited from the greatest bound down, their lists are added up exactly, and the search ends where no
block left can reach the k-th best cosine. The lists of the commonest terms, which nearly all examples are in, hold a weight for every
example instead: what they add up to is known exactly for all examples before, as one product for some texts at a time, and is
part of the bounds. Votes of the nearest count by a high power of the cosine, against a small weight of the
share of label 1 among examples without telling terms: neighbours that share a few plain words with a text decide
nothing, a copy decides alone. Votes are turned into probabilities by a logistic curve that is fitted on the examples
themselves, each scored without itself.

The sample is bounded (``rows_per_label`` rows of each label by a hash of the id, and whole texts of at most
``chars_per_label`` characters in all), and so are its words, the index and the calibration; all rows are scored.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import Memo, crc32_of_id, free_name, read, shared, staged

REST = 0.3
POWER = 6  # of the cosine, in votes
DOUBT = 0.05  # rows of the label of least weight, in votes
BLOCK = 16  # examples
FIRST_BLOCKS = 8  # to visit before the k-th best is looked at
HEAD_TERMS = 512  # the commonest, whose lists hold a weight for every example
_SLACK = 1e-9  # sums in another order differ by less
_TEXTS_AT_ONCE = 64
_DIMENSIONS = 128
_WORDS = re.compile(r"[^\W\d_]+").findall


@dataclass(frozen=True)
class Settings:
    rows_per_label: int = 2_000
    chars_per_label: int = 20_000_000
    least_chi_square: float = 60.0
    least_ratio: float = 3.0  # between a term's shares of the two labels, either way
    nearest: int = 25


BEGINNINGS = (4, 5, 6, 7)


def terms_of(word: str) -> list[str]:
    """The word and its beginnings; these are marked with a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def words_of(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def counted_terms(words: list[str], known) -> dict:
    """Counts of the terms of ``words``; ``known[word]`` gives those of a word."""
    counts: dict = {}
    for word, n in Counter(words).items():
        for term in known[word]:
            counts[term] = counts.get(term, 0) + n
    return counts


class ToxicityIndex:
    def __init__(
        self,
        terms: list[str],
        examples: Iterable[tuple[int, int, dict[str, int]]],
        weight: dict[int, float],
        k: int,
        words: list[str] = (),
    ):
        """examples: (doc_id, label, counts of terms and words), read once; weight: how many labelled rows an example of a label
        stands for; terms: those that tell the labels apart; words: all others."""
        self.number = {t: i for i, t in enumerate(terms)}
        self.other = {w: i for i, w in enumerate(words, len(terms))}
        ids, labels, sizes, at, counts = array("q"), array("d"), array("q"), array("i"), array("d")
        for doc_id, label, own in examples:
            ids.append(doc_id)
            labels.append(label)
            sizes.append(len(own))
            at.extend(map(self.at, own))
            counts.extend(own.values())
        self.k, n = k, len(ids)
        self.ids, self.labels, sizes = np.array(ids), np.array(labels), np.array(sizes, np.int64)
        self.weights = np.array([weight[label] for label in labels], np.float64)
        size = len(self.number) + len(self.other)
        at, counts, ends = np.array(at, np.int64), np.array(counts), np.cumsum(sizes)
        df = np.bincount(at, minlength=size)
        self.idf = np.log((1 + n) / (1 + df)) + 1
        vectors = [self.weighed(at[end - m : end], counts[end - m : end]) for m, end in zip(sizes, ends)]
        at = np.concatenate([*(v[0] for v in vectors), np.zeros(0, np.int64)])
        weights = np.concatenate([*(v[1] for v in vectors), np.zeros(0)])
        self.example = _like_together(at, weights, sizes, size)  # at each place
        self.place = np.argsort(self.example)
        place = np.repeat(self.place, sizes) if n else np.zeros(0, np.int64)
        self.row = np.full(size, -1)  # of the commonest terms in ``dense``
        head = np.argsort(-df, kind="stable")[:HEAD_TERMS]
        self.row[head] = np.arange(len(head))
        common = self.row[at] >= 0
        self.dense = np.zeros((n, len(head)))
        self.dense[place[common], self.row[at[common]]] = weights[common]
        at, place, weights = at[~common], place[~common], weights[~common]
        order = np.lexsort((place, at))
        at, place = at[order], place[order]
        self.lists, self.list_weights = place.astype(np.intp), weights[order]
        # An entry is a term in a block: its first list row, the block, and the greatest weight.
        block = place // BLOCK
        begins = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (block[1:] != block[:-1])]) if len(at) else np.zeros(0, np.int64)
        self.entry_starts = np.r_[begins, len(at)].astype(np.int64)
        self.entry_block = block[begins].astype(np.intp)
        self.entry_most = np.maximum.reduceat(self.list_weights, begins) if len(at) else np.zeros(0)
        self.starts = np.r_[0, np.cumsum(np.bincount(at[begins], minlength=size))].astype(np.int64)
        self.blocks = -(-n // BLOCK)
        self.offered = self.visited = 0  # blocks with a bound above 0, and those of them that were added up
        # What shares no term with any example is like the examples without telling terms.
        bare = np.array([not (v[0] < len(terms)).any() for v in vectors], bool)
        self.none = self.smoothed(self.labels[bare], self.weights[bare])
        self.slope, self.shift = self.calibrate(vectors)
        self.of_word = Memo(self.known_terms)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "of_word"}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self.of_word = Memo(self.known_terms)

    def at(self, term: str) -> int:
        return self.number[term] if term in self.number else self.other[term]

    def known_terms(self, word: str) -> tuple[int, ...]:
        found = (self.number.get(t) for t in terms_of(word))
        own = self.other.get(word)
        return tuple(t for t in (own, *found) if t is not None)

    @staticmethod
    def smoothed(labels: np.ndarray, weights: np.ndarray) -> float:
        """Share of label 1, drawn towards a half by one row of each label; a half without examples."""
        return float((labels @ weights + 0.5) / (weights.sum() + 1))

    def weighed(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit vector of numbered terms with their counts, as terms and weights, by term."""
        order = np.argsort(at)
        at = at[order]
        raw = (1 + np.log(counts[order])) * self.idf[at]
        telling = int(np.searchsorted(at, len(self.number)))
        if 0 < telling < len(at):
            raw[telling:] *= REST * math.sqrt((raw[:telling] ** 2).sum() / (raw[telling:] ** 2).sum())
        return at, raw / math.sqrt((raw**2).sum()) if len(at) else raw

    def vector(self, counts: dict[str, int]) -> tuple[tuple[int, float], ...]:
        """Unit vector as (term, weight), by term."""
        at, weights = self.weighed(np.array([self.at(t) for t in counts], np.int64), np.array(list(counts.values()), np.float64))
        return tuple(zip(at.tolist(), weights.tolist()))

    def nearest(self, vector: tuple[tuple[int, float], ...], without: int = -1) -> list[tuple[float, int]]:
        """The k examples of greatest cosine above zero, nearest first, the lower number first of equals."""
        cosine, some = self.near(np.array([t for t, _ in vector], np.int64), np.array([w for _, w in vector]), without)
        return list(zip(cosine.tolist(), some.tolist()))

    def near(self, at: np.ndarray, weights: np.ndarray, without: int = -1, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and numbers of the nearest, as ``nearest`` gives them; ``common``: what the commonest terms add up to, by place."""
        row = self.row[at]
        if common is None:
            common = self.dense @ self.of_common([(at, weights)])[:, 0]
        at, weights = at[row < 0], weights[row < 0]
        entries, of_term = _spans(self.starts[at], self.starts[at + 1])
        weights = weights[of_term]
        block = self.entry_block[entries]
        bound = np.maximum.reduceat(common, np.arange(0, len(common), BLOCK)) if len(common) else np.zeros(0)
        bound += np.bincount(block, weights * self.entry_most[entries], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound)]
        bound = bound[order] + _SLACK
        self.offered += len(order)
        cosine, least, first = np.zeros(len(self.ids)), 0.0, 0
        # Some blocks first, for a k-th best; then all that can reach it.
        for most in (max(FIRST_BLOCKS, 2 * -(-self.k // BLOCK)), len(order)):
            last = min(most, int(np.searchsorted(-bound, -least, side="right")))
            if last <= first:
                break
            chosen = np.zeros(self.blocks, bool)
            chosen[order[first:last]] = True
            mine = np.flatnonzero(chosen[block])
            own, of_entry = _spans(self.entry_starts[entries[mine]], self.entry_starts[entries[mine] + 1])
            cosine += np.bincount(self.lists[own], weights[mine][of_entry] * self.list_weights[own], len(cosine))
            cosine += np.where(np.repeat(chosen, BLOCK)[: len(cosine)], common, 0)
            if without >= 0:
                cosine[self.place[without]] = 0
            found = cosine[cosine > 0]
            if len(found) > self.k:
                least = np.partition(found, -self.k)[-self.k]
            self.visited += last - first
            first = last
        # Rounded, so that equal vectors tie whatever the order of their sums.
        some = np.flatnonzero((cosine >= least - _SLACK) & (cosine > 0))
        cosine, example = np.round(cosine[some], 12), self.example[some]
        best = np.lexsort((example, -cosine))[: self.k]
        best = best[cosine[best] > 0]
        return cosine[best], example[best]

    def of_common(self, vectors: list) -> np.ndarray:
        """The weights of the commonest terms, a column for each vector."""
        out = np.zeros((self.dense.shape[1], len(vectors)))
        for column, (at, weights) in enumerate(vectors):
            row = self.row[at]
            out[row[row >= 0], column] = weights[row >= 0]
        return out

    def vote(self, cosine: np.ndarray, example: np.ndarray) -> float:
        """Share of label 1 among the nearest, by closeness and by the rows each stands for, and a little of ``none``."""
        weight = np.minimum(cosine, 1.0) ** POWER * self.weights[example]
        doubt = DOUBT * float(self.weights.min())
        return float((weight @ self.labels[example] + doubt * self.none) / (weight.sum() + doubt))

    def calibrate(self, vectors: list) -> tuple[float, float]:
        """Slope and shift of the logistic curve from votes to labels; targets are smoothed, the slope is never negative."""
        votes, labels, weights = [], [], []
        for example, vector in enumerate(vectors):
            cosine, near = self.near(*vector, without=example)
            if len(near):
                votes.append(self.vote(cosine, near))
                labels.append(self.labels[example])
                weights.append(self.weights[example])
        if not votes:
            return 0.0, 0.0
        x, y, w = np.array(votes) - 0.5, np.array(labels), np.array(weights)
        ones, zeros = float(y @ w), float((1 - y) @ w)
        target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        slope, shift = 4.0, 0.0
        for _ in range(100):
            p = 1 / (1 + np.exp(-(slope * x + shift)))
            h = w * p * (1 - p)
            g = np.array([(w * (target - p)) @ x - 0.05 * (slope - 4), (w * (target - p)).sum() - 0.05 * shift])
            hess = np.array([[h @ (x * x) + 0.05, h @ x], [h @ x, h.sum() + 0.05]])
            move = np.linalg.solve(hess, g)
            slope, shift = slope + float(np.clip(move[0], -2, 2)), shift + float(np.clip(move[1], -2, 2))
            if np.abs(move).max() < 1e-9:
                break
        return max(slope, 0.0), shift

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float, int]]]:
        """(probability of label 1, evidence: doc_id, cosine and label of the nearest examples)."""
        score, cosine, near = self.scored(text)
        return score, list(zip(self.ids[near].tolist(), cosine.tolist(), self.labels[near].astype(int).tolist()))

    def scored(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        """(probability of label 1, cosines and numbers of the nearest)."""
        return self.all_scored([text])[0]

    def all_scored(self, texts: list[str | None]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        vectors = [self.weighed_terms(text) for text in texts]
        common = self.dense @ self.of_common(vectors)
        return [self.rated(*vector, np.ascontiguousarray(common[:, i])) for i, vector in enumerate(vectors)]

    def weighed_terms(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """A text's unit vector, as terms and weights."""
        counts = Counter(words_of(text))
        terms = list(map(self.of_word.__getitem__, counts))
        n = np.repeat(np.fromiter(counts.values(), np.float64, len(counts)), np.fromiter(map(len, terms), np.int64, len(terms)))
        at, of = np.unique(np.fromiter(chain.from_iterable(terms), np.int64, len(n)), return_inverse=True)
        return self.weighed(at, np.bincount(of, n, len(at)))

    def rated(self, at: np.ndarray, weights: np.ndarray, common: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        cosine, near = self.near(at, weights, common=common) if len(at) else (np.zeros(0), np.zeros(0, np.int64))
        if not len(near):
            return self.none, cosine, near
        return 1 / (1 + math.exp(-(self.slope * (self.vote(cosine, near) - 0.5) + self.shift))), cosine, near


def _like_together(at: np.ndarray, weights: np.ndarray, sizes: np.ndarray, n_terms: int) -> np.ndarray:
    """The examples in an order that has like ones side by side: halved again and again along the direction in which they
    differ most, in some hundred dimensions onto which their terms are dealt at random."""
    rng = np.random.default_rng(0)
    dealt, signs = rng.integers(0, _DIMENSIONS, n_terms), rng.choice([-1.0, 1.0], n_terms)
    row = np.repeat(np.arange(len(sizes)), sizes)
    points = np.bincount(row * _DIMENSIONS + dealt[at], signs[at] * weights, len(sizes) * _DIMENSIONS).reshape(-1, _DIMENSIONS)
    done, waiting = [], [np.arange(len(sizes))]
    while waiting:
        own = waiting.pop()
        if len(own) <= BLOCK:
            done.append(own)
            continue
        centred = points[own] - points[own].mean(axis=0)
        along = centred @ np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = own[np.argsort(along, kind="stable")]
        half = -(-len(own) // (2 * BLOCK)) * BLOCK  # whole blocks on the left
        waiting += [order[half:], order[:half]]
    return np.concatenate([*done, np.zeros(0, np.int64)]).astype(np.int64)


def _spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each ``first`` up to its ``last``, and which pair each comes from."""
    n = last - first
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) + (first - np.cumsum(n) + n)[of], of


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word with its neighbours, and the label."""
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text)
            found = {(w, hash_pair(a, b)) for a, w, b in zip(["", *words[:-1]], words, [*words[1:], ""])}
            if found:
                w, around = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(w), pa.int32()), pa.array(w, pa.string()), pa.array(around, pa.int64())],
                    ["label", "term", "around"],
                )


def hash_pair(left: str, right: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(f"{left} {right}") >> 1


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> ToxicityIndex:
    """The index of the examples in ``labels`` (doc_id, toxic) with their texts in ``docs``.

    Labels of the same doc_id count as 1 if any is; null labels and ids are left out. Of rows with the same id one text
    counts, the first in order; equal texts are one example, and null texts count as empty. Without examples every score
    is a half.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max((F.col("toxic") == 1).cast("int")).alias("label")
    )
    totals = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # The rows of least hash. Nearly all others go before any are sorted: what is left has about rows_per_label rows.
    most = F.lit(2**63 - 1)
    for label, n in totals.items():
        share = (settings.rows_per_label + 10 * math.sqrt(settings.rows_per_label) + 10) / n
        if share < 1:
            most = F.when(F.col("label") == label, F.lit(int(-(2**63) + share * 2**64))).otherwise(most)
    by_hash = Window.partitionBy("label").orderBy("hash", "doc_id")
    chosen = marked.withColumn("hash", F.xxhash64("doc_id")).filter(F.col("hash") <= most)
    chosen = chosen.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= settings.rows_per_label)
    # At most 2 * rows_per_label ids.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen.drop("hash")), "doc_id")
    rows = rows.groupBy("label", "place", "doc_id").agg(F.min("text").alias("text"))
    rows = rows.groupBy("label", "text").agg(F.min("place").alias("place"), F.min("doc_id").alias("doc_id"))
    so_far = Window.partitionBy("label").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("before", F.sum(F.length("text")).over(so_far) - F.length("text"))
    sample = staged(rows.filter(F.col("before") < settings.chars_per_label).select("doc_id", "label", "text"), "examples")
    contexts = (
        sample.select("label", "text")
        .mapInArrow(_contexts, "label int, term string, around long")
        .groupBy("label", "term", "around")
        .agg(F.lit(1).alias("one"))
        .groupBy("term")
        .agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"))
    )
    contexts = staged(contexts, "word-contexts")
    beginnings = F.array(
        *[F.when(F.length("term") > n, F.concat(F.substring("term", 1, n), F.lit("*"))) for n in BEGINNINGS]
    )
    each = F.explode(F.concat(F.array("term"), F.filter(beginnings, lambda t: t.isNotNull())))
    by_term = contexts.select(each.alias("term"), "ones", "zeros").groupBy("term")
    both = contexts.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).first()
    terms: list[str] = []
    if both["ones"] and both["zeros"]:
        ones, zeros = F.lit(float(both["ones"])), F.lit(float(both["zeros"]))
        n, a, b = ones + zeros, F.col("ones"), F.col("zeros")
        c, d = ones - a, zeros - b
        chi = n * (a * d - b * c) ** 2 / ((a + b) * (c + d) * ones * zeros)
        share, other = a / ones, b / zeros
        telling = (chi >= settings.least_chi_square) & (
            (share >= settings.least_ratio * other) | (other >= settings.least_ratio * share)
        )
        counts = by_term.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        found = counts.filter(telling).select("term", chi.alias("chi"))
        # At most the words of the sample and their beginnings.
        terms = [r["term"] for r in found.orderBy(F.desc("chi"), "term").collect()]
    known = shared(docs.sparkSession, frozenset(terms))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known()
        # The word itself always, its beginnings if they tell the labels apart.
        of_word = Memo(lambda word: [t for t in terms_of(word) if t == word or t in wanted])
        for batch in batches:
            counts = [counted_terms(words_of(t), of_word) for t in batch.column(2).to_pylist()]
            terms_, numbers = pa.array([list(c) for c in counts], pa.list_(pa.string())), [list(c.values()) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), terms_, pa.array(numbers, pa.list_(pa.int64()))],
                ["doc_id", "label", "terms", "counts"],
            )

    # Columns, and a row at a time: as rows of maps the same would take ten times the memory.
    examples = sample.mapInArrow(counted, "doc_id long, label int, terms array<string>, counts array<long>").toArrow()
    examples = examples.sort_by("doc_id").combine_chunks()
    labels_ = examples.column("label").to_pylist()
    seen = Counter(labels_)
    weight = {label: totals.get(label, 0) / n for label, n in seen.items()}
    every = pc.unique(pc.list_flatten(examples.column("terms"))).to_pylist() if labels_ else []
    words = sorted(set(every).difference(terms))
    rows = (
        (doc_id, label, dict(zip(t.as_py(), c.as_py())))
        for doc_id, label, t, c in zip(examples.column("doc_id").to_pylist(), labels_, examples.column("terms"), examples.column("counts"))
    )
    return ToxicityIndex(terms, rows, weight, settings.nearest, words)


SCORED = "score double, evidence array<struct<doc_id:long,cosine:double,label:int>>"


def toxicity_column(spark: SparkSession, text: Column, index: ToxicityIndex) -> Column:
    the_index = shared(spark, index)

    @F.arrow_udf(SCORED)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = the_index()
        for texts in batches:
            rows = []
            for first in range(0, len(texts), _TEXTS_AT_ONCE):
                rows.extend(known.all_scored(texts.slice(first, _TEXTS_AT_ONCE).to_pylist()))
            yield _as_structs(known, rows)

    return scored(text)


def _as_structs(known: ToxicityIndex, rows: list[tuple[float, np.ndarray, np.ndarray]]) -> pa.StructArray:
    near = np.concatenate([*(r[2] for r in rows), np.zeros(0, np.int64)])
    cosine = np.concatenate([*(r[1] for r in rows), np.zeros(0)])
    ends = np.cumsum([0, *(len(r[2]) for r in rows)]).astype(np.int32)
    each = pa.StructArray.from_arrays(
        [pa.array(known.ids[near]), pa.array(cosine), pa.array(known.labels[near].astype(np.int32))], ["doc_id", "cosine", "label"]
    )
    scores = pa.array([r[0] for r in rows], pa.float64())
    return pa.StructArray.from_arrays([scores, pa.ListArray.from_arrays(pa.array(ends), each)], ["score", "evidence"])


def score_toxicity(docs: DataFrame, index: ToxicityIndex) -> DataFrame:
    """``docs`` with score, predicted and evidence after its columns (columns of these names are replaced).

    Only the text decides. A null, empty or word-less text, like any text without a word of an example, gets the share
    of toxic rows among examples without telling terms and no evidence. Repeated rows are scored each; an empty table gives no rows.
    Very long texts are scored whole, in time proportional to their length. Of equally near examples the smaller doc_id is evidence.
    """
    found = free_name(docs, "_toxicity")
    scored = docs.withColumn(found, toxicity_column(docs.sparkSession, F.col("text"), index))
    return scored.withColumns(
        {
            "score": F.col(f"{found}.score"),
            "predicted": (F.col(f"{found}.score") >= 0.5).cast("int"),
            "evidence": F.col(f"{found}.evidence"),
        }
    ).drop(found)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    labels = read(spark, folder, "labels").filter(crc32_of_id("doc_id") % 5 != 0)
    index = fit(docs, labels)
    held_out = F.coalesce(crc32_of_id("doc_id") % 5 == 0, F.lit(False)).alias("held_out")
    return score_toxicity(docs.select("doc_id", "text", held_out), index).drop("text")
