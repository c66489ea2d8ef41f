"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A text is cut where no pair of tokens can reach across (after every run that is not white space), and each unit is
counted once per worker while it is remembered. Within a unit, the vocabulary's own split pattern gives the words.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import MEMO_ENTRIES, Memo, free_name, read, shared

# The split pattern of byte-level vocabularies, and white space as the tokenizer library has it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\t-\r \x85\xa0  -     　"
TOKEN_LIMIT = 1024


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class TokenCounter:
    """Counts of one vocabulary. Symbols are numbers: 0 to 255 the bytes, further ones the results of merges."""

    def __init__(self, merges: list[tuple[str, str]], specials: list[str]):
        letter = byte_letters()
        number = {letter[b]: b for b in range(256)}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, (left, right) in enumerate(merges):
            self.made.append(number.setdefault(left + right, 256 + rank))
            self.rank.setdefault((number[left], number[right]), rank)
        self.specials = specials
        self._ready()

    def _ready(self) -> None:
        self.units = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.words = regex.compile(SPLIT.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")).findall
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.of_word, self.of_unit = Memo(self.merged, 2 * MEMO_ENTRIES), Memo(self.in_unit)

    def __getstate__(self):
        return {"rank": self.rank, "made": self.made, "specials": self.specials}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self._ready()

    def count(self, text: str) -> int:
        return sum(map(self.of_unit.__getitem__, self.units(text)))

    def in_unit(self, unit: str) -> int:
        if (unit[1:] if unit[0] == " " else unit).isalpha():
            return self.of_word[unit]
        if not self.special or not self.special.search(unit):
            return sum(map(self.of_word.__getitem__, self.words(unit)))
        parts = self.special.split(unit)
        return len(parts) - 1 + sum(self.of_word[word] for part in parts for word in self.words(part))

    def merged(self, word: str) -> int:
        """Symbols left when no adjacent pair has a rank. The lowest rank goes first, the leftmost of equal ones."""
        find, made = self.rank.get, self.made
        symbols = list(word.encode("utf-8"))
        n = left = len(symbols)
        shift = 14 if n <= 16_384 else 40  # an entry is rank and place in one number, small where it can be
        heap, at = [], 0
        for pair in zip(symbols, symbols[1:]):
            if (found := find(pair)) is not None:
                heap.append(found << shift | at)
            at += 1
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        mask = (1 << shift) - 1
        while heap:
            entry = heappop(heap)
            at, lowest = entry & mask, entry >> shift
            then = after[at]
            if then >= n or find((symbols[at], symbols[then])) != lowest:
                continue  # one of the two has been merged meanwhile
            symbols[at] = new = made[lowest]
            symbols[then] = -1
            left -= 1
            after[at] = nxt = after[then]
            if nxt < n:
                before[nxt] = at
                if (found := find((new, symbols[nxt]))) is not None:
                    heappush(heap, found << shift | at)
            if (prev := before[at]) >= 0 and (found := find((symbols[prev], new))) is not None:
                heappush(heap, found << shift | prev)
        return left


def load_counter(path: str) -> TokenCounter:
    """Counter of a byte-level BPE file of the tokenizers library. Added tokens in a text count one each."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    return TokenCounter(merges, [t["content"] for t in spec["added_tokens"]])


def token_count(spark: SparkSession, text: Column, path: str | None = None) -> Column:
    """Tokens of each text as a long; a null or empty text has none. The merges are broadcast: one vocabulary file."""
    the_counter = shared(spark, load_counter(path or default_vocabulary()))

    @F.pandas_udf("long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = the_counter()
        for texts in batches:
            yield pd.Series([counter.count(text) if text else 0 for text in texts], dtype="int64")

    return counts(text)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = TOKEN_LIMIT, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit after its columns, one row per row.

    Null text counts as empty (0 and 0, false); repeated rows are counted each; a column of ``docs`` that already
    has one of the three names is replaced; an empty table gives no rows. Very long words merge in n log n steps.
    """
    tokens = free_name(docs, "_tokens")
    counted = docs.withColumn(tokens, token_count(docs.sparkSession, F.col(text), path))
    return counted.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
            "n_tokens": F.col(tokens),
            "over_limit": F.col(tokens) > limit,
        }
    ).drop(tokens)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(read(spark, folder, "documents").select("doc_id", "text")).drop("text")
