"""Language identification by words first, then by ever shorter character n-grams.

A word that the model knows is scored by its log frequency in each language. Any other word is scored by the mean
over its character n-grams of the greatest length of which the model knows at least one, down to single letters.
A text's score is the mean over its words.

The model is fitted on a bounded sample of the labelled rows, of all languages that they name: ``rows_per_language`` of
them (fewer if more than ``rows`` in all), taken by a hash of the row, and of these as many as have ``chars_per_language``
characters in all, each whole. Counting, and the choice of the most frequent words and n-grams, run on Spark; what is broadcast
has at most (1 + n-gram lengths) * ``entries_per_length`` entries a language and ``entries`` in all, whatever the size
of the table. A model keeps an entry's frequencies of the languages that have it only, and n-grams by a 64-bit hash in a sorted array.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import MEMO_KEY_CHARS, Memo, crc32_of_id, free_name, read, shared

UNDETERMINED = "und"
_WORDS = re.compile(r"[^\W\d_]+").findall
UNSEEN_ENTRIES = 80_000  # of words that a worker remembers beside the model; fewer if there are many languages
_GRAMS_AT_ONCE = 10_000
_WORDS_AT_ONCE = 20_000
_TEXTS_AT_ONCE = 100


@dataclass(frozen=True)
class Settings:
    rows_per_language: int = 1_000
    rows: int = 200_000  # of all languages; many languages share them evenly
    chars_per_language: int = 4_000_000
    entries_per_length: int = 30_000
    longest_gram: int = 5
    least_count: int = 2
    penalty: float = 7.0  # minus log10 frequency of what a language does not have
    entries: int = 1_200_000  # of all languages and lengths; many languages share them evenly


def words_of(text: str) -> Counter:
    """Lower-case runs of letters, normalised, with their counts."""
    return Counter(_WORDS(unicodedata.normalize("NFC", text).lower()))


def grams_of(word: str, length: int) -> list[str]:
    padded = f" {word} " if length > 1 else word
    return [padded[i : i + length] for i in range(len(padded) - length + 1)]


def _hashes(grams: Iterable[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, grams), np.uint64)


class LanguageModel:
    """Penalties (minus log10 of the relative frequency) of words and n-grams by language; lower is likelier."""

    def __init__(self, languages: list[str], entries: Iterable[tuple[int, str, int, int]], longest: int, penalty: float):
        """entries: (length, or 0 for a whole word; text; language number; count), those of a text in any order."""
        self.languages, self.longest, self.penalty = languages, longest, penalty
        self.words: dict[str, int] = {}
        places: dict[str, int] = {}
        lengths, rows, of, counts = [], [], [], []
        for length, text, language, n in entries:
            known = places if length else self.words
            # A row for each word and each n-gram; n-grams of different lengths are different texts.
            rows.append(known.setdefault(text, len(places) + len(self.words)))
            lengths.append(length)
            of.append(language)
            counts.append(n)
        lengths, rows, of, counts = (np.array(x, np.int64) for x in (lengths, rows, of, counts))
        totals = np.bincount(lengths * len(languages) + of, counts, (longest + 1) * len(languages)).reshape(longest + 1, -1)
        order = np.argsort(rows, kind="stable")
        lengths, rows, of, counts = lengths[order], rows[order], of[order], counts[order]
        # Of each row the languages that have it, and by how much they are likelier than those that do not.
        share = -np.log10(counts / totals[lengths, of]) if len(counts) else np.zeros(0)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(places) + len(self.words)))]).astype(np.int64)
        self.of = of.astype(np.int32)
        self.gain = (penalty - np.minimum(penalty, share)).astype(np.float32)
        keys, own = _hashes(places), np.fromiter(places.values(), np.int32, len(places))
        order = np.argsort(keys)
        self.gram_keys, self.gram_rows = keys[order], own[order]
        self._ready()

    def _ready(self) -> None:
        self.of_word = Memo(self.unseen, max(1, min(UNSEEN_ENTRIES, 20 * UNSEEN_ENTRIES // max(1, len(self.languages)))))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "of_word"}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self._ready()

    def __len__(self) -> int:
        return len(self.of)

    def gains(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weighted sum of what the rows take off each language's penalty."""
        first = self.starts[rows]
        n = self.starts[rows + 1] - first
        at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        return np.bincount(self.of[at], np.repeat(weight, n) * self.gain[at], len(self.languages))

    def score(self, word: str) -> np.ndarray | None:
        """Penalty by language; None if there is no letter in it."""
        row = self.words.get(word)
        if row is not None:
            return self.penalty - self.gains(np.array([row]), np.ones(1))
        return np.frombuffer(found, np.float32) if (found := self.of_word[word]) else None

    def unseen(self, word: str) -> bytes:
        """The penalties of a word that is not known, as 32-bit numbers; empty if there is no letter in it."""
        if not any(map(str.isalpha, word)):
            return b""
        for length in range(self.longest, 0, -1):
            known, gained = 0, np.zeros(len(self.languages))
            for rows in self.rows_of_grams(word, length):
                known += len(rows)
                gained += self.gains(rows, np.ones(len(rows)))
            if known:
                # An n-gram that no language has says nothing and counts for none of them.
                return (self.penalty - gained / known).astype(np.float32).tobytes()
        return np.full(len(self.languages), self.penalty, np.float32).tobytes()

    def rows_of_grams(self, word: str, length: int) -> Iterator[np.ndarray]:
        """The rows of a word's n-grams that are known, some thousand n-grams at a time."""
        padded = f" {word} " if length > 1 else word
        for first in range(0, len(padded) - length + 1, _GRAMS_AT_ONCE):
            last = min(first + _GRAMS_AT_ONCE, len(padded) - length + 1)
            keys = _hashes(padded[i : i + length] for i in range(first, last))
            at = np.searchsorted(self.gram_keys, keys)
            at[at == len(self.gram_keys)] = 0
            yield self.gram_rows[at[self.gram_keys[at] == keys]] if len(self.gram_keys) else at[:0]

    def penalties(self, words: set[str]) -> dict[str, bytes]:
        """Of words that the model does not know, as ``unseen`` gives them one by one; what is new is worked out together."""
        memo, found, new = self.of_word, {}, []
        for word in words:
            value = memo.get(word)
            if value is None:
                value = memo.older.get(word)
            if value is not None:
                found[word] = value
            elif len(word) > MEMO_KEY_CHARS:
                found[word] = self.unseen(word)
            else:
                new.append(word)
        for first in range(0, len(new), _WORDS_AT_ONCE):
            part = new[first : first + _WORDS_AT_ONCE]
            found.update(zip(part, self.unseen_together(part)))
        if len(memo) + len(found) > memo.entries:
            memo.turn()
        if len(found) <= memo.entries:
            memo.update(found)
        return found

    def unseen_together(self, words: list[str]) -> list[bytes]:
        languages = len(self.languages)
        nothing = np.full(languages, self.penalty, np.float32).tobytes()
        out = [nothing if word.isalpha() or any(map(str.isalpha, word)) else b"" for word in words]
        waiting = [i for i, value in enumerate(out) if value]
        for length in range(self.longest, 0, -1):
            grams = [grams_of(words[i], length) for i in waiting]
            keys = _hashes(chain.from_iterable(grams))
            if not len(keys) or not len(self.gram_keys):
                continue
            at = np.searchsorted(self.gram_keys, keys)
            at[at == len(self.gram_keys)] = 0
            hit = self.gram_keys[at] == keys
            of = np.repeat(np.arange(len(waiting)), np.fromiter(map(len, grams), np.int64, len(grams)))[hit]
            rows = self.gram_rows[at[hit]]
            first = self.starts[rows]
            n = self.starts[rows + 1] - first
            entry = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
            gained = np.bincount(np.repeat(of, n) * languages + self.of[entry], self.gain[entry], len(waiting) * languages)
            known = np.bincount(of, minlength=len(waiting))
            # An n-gram that no language has says nothing and counts for none of them.
            mean = self.penalty - gained.reshape(-1, languages) / np.maximum(known, 1)[:, None]
            mean = mean.astype(np.float32)
            for place in np.flatnonzero(known):
                out[waiting[place]] = mean[place].tobytes()
            waiting = [i for i, some in zip(waiting, known) if not some]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of belief in it). Ties go to the language that comes first by name."""
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        counted = [words_of(text) if text else Counter() for text in texts]
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        new = self.penalties(set().union(*counted).difference(self.words))
        return [self.predicted(counts, new) for counts in counted]

    def predicted(self, counts: Counter, new: dict[str, bytes]) -> tuple[str, float]:
        weight = np.fromiter(counts.values(), np.float64, len(counts))
        rows = np.fromiter((self.words.get(word, -1) for word in counts), np.int64, len(counts))
        known = rows >= 0
        own = weight[known]
        size = own.sum()
        total = self.penalty * size - self.gains(rows[known], own)
        if not known.all():
            found = [new.get(word, b"") for word in counts]
            own = weight[np.fromiter(map(len, found), np.int64, len(found)) > 0]
            penalties = np.frombuffer(b"".join(found), np.float32).reshape(len(own), len(self.languages))
            total, size = total + own @ penalties.astype(np.float64), size + own.sum()
        if not size:
            return UNDETERMINED, 0.0
        mean = total / size
        # Words of a text are not independent: the evidence of n words counts as that of sqrt(n).
        belief = np.exp((mean.min() - mean) * math.log(10) * math.sqrt(size))
        best = int(np.argmin(mean))
        return self.languages[best], float(belief[best] / belief.sum())


def _counted(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_length = [words_of(text)]
            for length in range(1, longest + 1):
                grams: Counter = Counter()
                for word, n in by_length[0].items():
                    for gram in grams_of(word, length):
                        grams[gram] += n
                by_length.append(grams)
            for length, counts in enumerate(by_length):
                if counts:
                    columns = [[language] * len(counts), [length] * len(counts), list(counts), list(counts.values())]
                    types = [pa.string(), pa.int32(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types)], ["lang", "length", "gram", "n"]
                    )


def fit(labelled: DataFrame, settings: Settings = Settings()) -> LanguageModel:
    """The model of the rows of ``labelled`` (text, lang), of which those with a null in either are left out."""
    rows = labelled.filter("lang is not null and text is not null").select(
        F.xxhash64("doc_id", "text").alias("row"), "lang", F.length("text").alias("chars")
    )
    # By the least hashes of a row. Nearly all other rows go before any are sorted: what is left of a language is
    # hardly more than its share, however many rows it has, and whatever part of them are copies.
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("row").alias("n"))
    languages = [(r["lang"], r["n"]) for r in sizes.orderBy("lang").collect()]
    per_language = min(settings.rows_per_language, max(1, settings.rows // max(1, len(languages))))
    wanted = 1.5 * per_language + 10 * math.sqrt(per_language) + 10
    most = [(lang, min(int(wanted / n * 2**64) - 2**63, 2**63 - 1)) for lang, n in languages]
    # A short row for each language, as in the model: rows need not meet by language to be told which of them to leave out.
    limits = labelled.sparkSession.createDataFrame(most, "lang string, most long")
    few = rows.join(F.broadcast(limits), "lang").filter(F.col("row") <= F.col("most")).drop("most")
    by_hash = Window.partitionBy("lang").orderBy("row")
    first = (
        few.groupBy("lang", "row").agg(F.min("chars").alias("chars"))
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= per_language)
        .withColumn("before", F.sum("chars").over(by_hash.rowsBetween(Window.unboundedPreceding, 0)) - F.col("chars"))
        .filter(F.col("before") < settings.chars_per_language)
        .select("row", "lang")
    )
    keyed = labelled.select(F.xxhash64("doc_id", "text").alias("row"), "lang", "text")
    # At most ``rows`` rows of two short columns, or one a language.
    sample = keyed.join(F.broadcast(first), ["row", "lang"]).groupBy("row", "lang").agg(F.min("text").alias("text"))
    longest = settings.longest_gram
    entries = max(1, min(settings.entries_per_length, settings.entries // (max(1, len(languages)) * (longest + 1))))
    counts = (
        sample.select("lang", "text")
        .mapInArrow(lambda batches: _counted(batches, longest), "lang string, length int, gram string, n long")
        .groupBy("lang", "length", "gram")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= settings.least_count)
    )
    frequent = Window.partitionBy("lang", "length").orderBy(F.desc("n"), "gram")
    kept = counts.withColumn("place", F.row_number().over(frequent)).filter(F.col("place") <= entries)
    table = kept.select("lang", "length", "gram", "n").toArrow()
    languages = sorted(pc.unique(table["lang"]).to_pylist())
    number = {language: i for i, language in enumerate(languages)}

    def rows_of_table() -> Iterator[tuple[int, str, int, int]]:
        for batch in table.to_batches(max_chunksize=10_000):
            lang, length, gram, n = (batch.column(i).to_pylist() for i in range(4))
            yield from zip(length, gram, map(number.__getitem__, lang), n)

    return LanguageModel(languages, rows_of_table(), longest, settings.penalty)


def language_column(spark: SparkSession, text: Column, model: LanguageModel) -> Column:
    """struct(lang_pred string, score double) of each text."""
    the_model = shared(spark, model)

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = the_model()
        for texts in batches:
            rows = []
            for first in range(0, len(texts), _TEXTS_AT_ONCE):
                rows.extend(known.predict_all(texts.slice(first, _TEXTS_AT_ONCE).to_pylist()))
            names, scores = zip(*rows) if rows else ((), ())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predicted(text)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score after its columns (columns of these names are replaced), one row per row.

    Only the text decides. ``und`` with score 0 where the text is null, empty or has no letter, and everywhere when
    the model has seen no labelled row. A text of letters of which the model knows none goes to the first language
    with an even score. Repeated rows are scored each; an empty table gives no rows. Very long texts and words are read whole.
    """
    found = free_name(docs, "_language")
    scored = docs.withColumn(found, language_column(docs.sparkSession, F.col("text"), model))
    return scored.withColumns({"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}).drop(found)


def accepted(docs: DataFrame, model: LanguageModel, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is determined with at least ``least_score``; all columns as they were."""
    found = free_name(docs, "_language")
    scored = docs.withColumn(found, language_column(docs.sparkSession, F.col("text"), model))
    sure = (F.col(f"{found}.lang_pred") != UNDETERMINED) & (F.col(f"{found}.score") >= least_score)
    return scored.filter(sure).drop(found)


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may teach: crc32 of the id modulo 4 is not 2. A row without an id does not teach."""
    return docs.filter(crc32_of_id("doc_id") % 4 != 2).select("doc_id", "text", "lang")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = fit(learnable(docs))
    held_out = F.coalesce(crc32_of_id("doc_id") % 4 == 2, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", "text", held_out), model).drop("text")
