"""From documents to packed training sequences, stage by stage.

Every stage gets all rows that the one before it kept, written as Parquet and read again, and gives rows with the
columns of documents; the last gives the pieces with their places in the sequences.

In all stages an empty table gives no rows, further columns pass through whatever their names (the last stage reads doc_id and
text only), and texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontamination, language_id, packing, secret_scans, simhash
from tallyhouse.llm.common import read, staged


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined. The model learns from the labelled rows among those it is given.

    Null, empty and letterless texts go. Without any labelled row no language can be determined and nothing stays.
    Equally likely languages: the first by name. Repeated rows and rows without doc_id are judged each.
    """
    return language_id.accepted(docs, language_id.fit(language_id.learnable(docs)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash: four-word shingles, four differing bits at most.

    The smallest doc_id of a group stays; an id comes before none, and of repeated rows one stays. Null, empty and blank texts
    are one group with fingerprint zero.
    """
    return simhash.one_of_each_group(docs, words=4, max_bits=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark item. Null and empty texts hold none; without items all stay.

    Repeated rows and rows without doc_id are judged each.
    """
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret; n_chars counts the new text.

    Null stays null and empty stays empty. Secrets that overlap get one mark. Repeated rows and rows without doc_id all stay.
    """
    return secret_scans.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its offset there. A null or empty text is its end token alone.

    Repeated rows and rows without doc_id are packed each. Documents of equal size go in any order, the same at every run.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", languages),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scans", without_secrets),
    ("best_fit_packing", packed),
]

# Language models, fingerprints and token ids are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
