"""Ranked lexical search by pipelined term partitioning.

The documents are indexed in blocks of at most ``BLOCK_DOCS``, each term's postings of a block in one row. Terms
belong to owners: the rarest to the first, the most common to the last. Items are dealt into bundles of some hundred, and a
bundle visits the owners one after another, once for every block: a stage cogroups the bundles' sparse accumulators
(an item's documents with their scores so far) with the postings of the stage's owner, adds its integer contributions,
and sends the accumulators on to the next. The last stage selects.

Between two stages the k-th best score so far of every item over all blocks becomes its least score. A contribution
is less than its term's weight times 1,000,000, so what the owners to come can still add is bounded, and an accumulator that cannot
reach its item's least score any more is dropped; a document that only later owners know cannot enter where all of
them together add too little. Both are exact: equal scores are kept, and no document of the result is ever dropped.

A group holds one block of documents and one bundle of items, whatever the size of the tables: a common term's postings
lie in as many rows as there are blocks.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import read, shared, staged

BLOCK_DOCS = 8_192
BLOCK_POSTINGS = 2_000_000
BUNDLE_ITEMS = 256
NEAREST = 10
# A term in at most this share of the documents belongs to the first owner, and so on; all others to the last.
OWNER_SHARES = (0.001, 0.01, 0.05)
# Items with more distinct terms than these are not sent to the tasks: all terms are indexed, and joined with the items'.
VOCABULARY_TERMS = 300_000

_UNIT = 1_000_000  # more than any contribution of weight 1
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The same rule on UTF-8: other ASCII characters than letters and digits part terms, and A-Z are lower-cased.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: Column) -> Column:
    """The terms of a text with repeats, as an array; null for a null text."""
    return F.regexp_extract_all(F.translate(text, _CAPITALS, _SMALL), F.lit(_TERM), F.lit(0))


class _Numbers(dict):
    """Numbers terms as they come."""

    def __missing__(self, term):
        self[term] = number = len(self)
        return number


# A row for each term of a block: places of its documents (16 bits), and occurrences (32 bits) in each. And a row without term
# for each block: all its documents' terms (32 bits) and ids.
INDEX = "block long, term string, docs binary, counts binary, ids array<long>, n_docs long, n_terms long"


def _indexed(batches: Iterator[pa.RecordBatch], wanted: dict[bytes, int] | None, block_docs: int) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    number = _Numbers() if wanted is None else wanted
    ids, sizes, found = [], array("I"), array("I")
    numbers, counts = array("I"), array("I")

    def closed() -> Iterator[pa.RecordBatch]:
        term, count = np.frombuffer(numbers, np.uint32), np.frombuffer(counts, np.uint32)
        doc = np.repeat(np.arange(len(ids), dtype=np.uint16), np.frombuffer(found, np.uint32))
        order = np.argsort(term, kind="stable")
        term, count, doc = term[order], count[order].astype("<u4"), doc[order].astype("<u2")
        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        text = dict(zip(number.values(), number))
        ends = [*starts[1:].tolist(), len(term)]
        n = np.frombuffer(sizes, np.uint32)
        rows = [(block, None, None, n.astype("<u4").tobytes(), ids, int((n > 0).sum()), int(n.sum()))]
        for first, last in zip(starts.tolist(), ends):
            word = text[int(term[first])].decode()
            rows.append((block, word, doc[first:last].tobytes(), count[first:last].tobytes(), None, last - first, 0))
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
        names = ["block", "term", "docs", "counts", "ids", "n_docs", "n_terms"]
        for first in range(0, len(rows), 10_000):
            part = zip(*rows[first : first + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, kinds)], names)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = text.encode().translate(_BYTES).split() if text else []
            own = Counter(words if wanted is None else filter(wanted.__contains__, words))
            ids.append(doc_id)
            sizes.append(len(words))
            found.append(len(own))
            numbers.extend(map(number.__getitem__, own))
            counts.extend(own.values())
            if len(ids) >= block_docs or len(numbers) >= BLOCK_POSTINGS:
                yield from closed()
                block += 1
                number = _Numbers() if wanted is None else wanted
                ids, sizes, found, numbers, counts = [], array("I"), array("I"), array("I"), array("I")
    if ids:
        yield from closed()


def index(docs: DataFrame, terms: DataFrame, block_docs: int = BLOCK_DOCS, vocabulary_terms: int = VOCABULARY_TERMS) -> DataFrame:
    """The postings of ``terms`` (term) in ``docs`` (doc_id, text), in blocks (``INDEX``).

    Up to ``vocabulary_terms`` terms go to the tasks, which leave out all others; of more, every term is indexed and Spark
    joins what is wanted.
    """
    if not 0 < block_docs <= 1 << 16:
        raise ValueError("a block's places have 16 bits")
    some = [r["term"] for r in terms.limit(vocabulary_terms + 1).collect()]
    the_terms = shared(docs.sparkSession, {t.encode(): i for i, t in enumerate(some)} if len(some) <= vocabulary_terms else None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda batches: _indexed(batches, the_terms(), block_docs), INDEX)


ACCUMULATORS = "bundle int, block long, item long, docs binary, scores binary, best array<long>"
FOUND = "item long, doc_id long, score long, block long, place int"


def _visit(result, n: int, total: int, nearest: int):
    """One owner's work on a bundle and a block."""

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        return result(_stage(left, right, n, total), nearest)

    return visit


def _stage(left: pa.Table, right: pa.Table, n: int, total: int) -> Iterator[tuple]:
    """(bundle, block, item, places, scores, ids): what each item of a bundle has in a block after this owner."""
    terms = right.column("term").to_pylist()
    at = terms.index(None)
    sizes = np.frombuffer(right.column("counts")[at].as_py(), "<u4").astype(np.int64)
    penalty = 8 * (10 + 90 * sizes * n // max(total, 1))
    bundle, block = (right.column(c)[at].as_py() for c in ("bundle", "block"))
    before = {r["item"]: r for r in left.to_pylist()}
    wanted, limits = defaultdict(list), {item: (r["least"], r["rest"], r["later"]) for item, r in before.items()}
    for row, items in enumerate(right.column("items").to_pylist()):
        for item in items or ():
            wanted[item["item"]].append(row)
            limits[item["item"]] = item["least"], item["rest"], item["later"]
    docs, parts = {}, {}
    for row, weight in enumerate(right.column("weight").to_pylist()):
        if row != at:
            docs[row] = np.frombuffer(right.column("docs")[row].as_py(), "<u2")
            count = np.frombuffer(right.column("counts")[row].as_py(), "<u4").astype(np.int64)
            parts[row] = weight * (1_000_000_000 * count // (1_000 * count + penalty[docs[row]]))
    ids = right.column("ids")[at]
    for item, (least, rest, later) in limits.items():
        scores = np.zeros(len(sizes), np.int64)
        if item in before:
            scores[np.frombuffer(before[item]["docs"], "<u2")] = np.frombuffer(before[item]["scores"], "<i8")
        fresh = rest * _UNIT >= least
        known = None if fresh else scores > 0
        for row in wanted.get(item, ()):
            scores[docs[row]] += parts[row]
        if not fresh:
            scores[~known] = 0
        places = np.flatnonzero((scores > 0) & (scores + later * _UNIT >= least))
        if len(places):
            yield bundle, block, item, places, scores[places], ids


def _best(scores: np.ndarray, nearest: int) -> np.ndarray:
    return np.sort(np.partition(scores, -nearest)[-nearest:] if len(scores) > nearest else scores)[::-1]


def search(
    docs: DataFrame, items: DataFrame, nearest: int = NEAREST, block_docs: int = BLOCK_DOCS,
    bundle_items: int = BUNDLE_ITEMS, vocabulary_terms: int = VOCABULARY_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``nearest`` documents of each item with a score above 0, best first.

    docs: doc_id, text; items: item_id, text. Further columns are not read. Equal scores go by doc_id, rows without id last; each
    row of ``docs`` is a document, repeated ones too. An item is an item_id (or none), with the terms of all its rows. Null and
    empty texts have no terms; very long texts count whole. No documents, no items or no common term: no rows.
    """
    spark = docs.sparkSession
    each = items.select("item_id", F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    items = each.groupBy("item_id").agg(F.collect_set("term").alias("terms"))
    items = staged(items.withColumn("item", F.monotonically_increasing_id()), "search-items")
    each = items.select("item", F.explode("terms").alias("term"))
    bundles = max(1, -(-items.count() // bundle_items))
    postings = staged(index(docs, staged(each.select("term").distinct(), "search-terms"), block_docs, vocabulary_terms), "search-index")
    total = postings.filter("term is null").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("terms")).first()
    n, length = total["n"] or 0, total["terms"] or 0
    df = postings.filter("term is not null").join(each.select("term").distinct(), "term", "left_semi")
    df = df.groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2.0 * F.col("df") + 1))).cast("long")
    owner = sum((F.col("df") > share * n).cast("int") for share in OWNER_SHARES)
    owners = len(OWNER_SHARES) + 1
    terms = staged(df.select("term", weight.alias("weight"), owner.alias("owner")), "search-weights")
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle")
    each = staged(each.join(terms, "term").select("item", bundle, "term", "weight", "owner"), "search-item-terms")
    # What the owners from each on can add to an item, in units.
    rests = [F.sum(F.when(F.col("owner") >= s, F.col("weight")).otherwise(0)).alias(f"from_{s}") for s in range(owners + 1)]
    known = staged(each.groupBy("item").agg(*rests), "search-bounds")
    lengths = postings.filter("term is null").withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))))
    accumulators, least = spark.createDataFrame([], ACCUMULATORS), None
    for stage in range(owners):
        limits = known.select(
            "item", F.col(f"from_{stage}").alias("rest"), F.col(f"from_{stage + 1}").alias("later"),
            *([] if least is not None else [F.lit(1).cast("long").alias("least")]),
        )
        if least is not None:
            limits = limits.join(least, "item", "left").withColumn("least", F.coalesce("least", F.lit(1)))
        asked = each.filter(F.col("owner") == stage).join(limits, "item").groupBy("bundle", "term").agg(
            F.first("weight").alias("weight"), F.collect_list(F.struct("item", "least", "rest", "later")).alias("items")
        )
        right = postings.join(asked, "term").unionByName(lengths, allowMissingColumns=True)
        left = accumulators.join(limits, "item")
        last = stage == owners - 1
        both = left.groupBy("bundle", "block").cogroup(right.groupBy("bundle", "block"))
        out = both.applyInArrow(_visit(_selected if last else _sent, n, length, nearest), FOUND if last else ACCUMULATORS)
        if not last:
            accumulators = staged(out, f"search-owner-{stage}")
            best = accumulators.select("item", F.explode("best").alias("score"))
            by_score = Window.partitionBy("item").orderBy(F.desc("score"))
            kth = best.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= nearest)
            kth = kth.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least"))
            least = staged(kth.filter(F.col("n") == nearest).select("item", "least"), f"search-least-{stage}")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("block"), F.asc("place")]
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= nearest).join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _sent(rows: Iterator[tuple], nearest: int) -> pa.Table:
    """Accumulators for the next owner, with the best scores of the block."""
    out = [
        (bundle, block, item, places.astype("<u2").tobytes(), scores.astype("<i8").tobytes(), _best(scores, nearest).tolist())
        for bundle, block, item, places, scores, _ in rows
    ]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = ["bundle", "block", "item", "docs", "scores", "best"]
    columns = zip(*out) if out else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _selected(rows: Iterator[tuple], nearest: int) -> pa.Table:
    """The best documents of the block for each item."""
    found = []
    for _, block, item, places, scores, ids in rows:
        some = np.flatnonzero(scores >= _best(scores, nearest)[-1])
        named = [(-int(scores[i]), (doc_id := ids[int(places[i])].as_py()) is None, doc_id or 0, int(places[i])) for i in some]
        for score, unnamed, doc_id, place in sorted(named)[:nearest]:
            found.append((item, None if unnamed else doc_id, -score, block, place))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    columns = zip(*found) if found else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item", "doc_id", "score", "block", "place"])


def op12_ranked_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


ORACLE = f"""
WITH texts AS (
    SELECT row_number() OVER () AS doc, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '{_TERM}') AS terms
    FROM documents
), sizes AS (
    SELECT count(*) FILTER (len(terms) > 0) AS n, sum(len(terms))::BIGINT AS total FROM texts
), postings AS (
    SELECT doc, any_value(doc_id) AS doc_id, any_value(size) AS size, term, count(*) AS tf
    FROM (SELECT doc, doc_id, len(terms) AS size, unnest(terms) AS term FROM texts) GROUP BY doc, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), sizes
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '{_TERM}')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc, any_value(doc_id) AS doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // total))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term), sizes GROUP BY item_id, doc
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, doc) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
