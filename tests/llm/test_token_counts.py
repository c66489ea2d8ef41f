import random

import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import token_counts as T

ALPHABET = [*"ab 's't\n\n\t  \x1c\x85\xa0 é漢1²½'ll_-<😀́​", "<|endoftext|>", "the", " of", "ing "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(T.default_vocabulary())


@pytest.fixture(scope="module")
def counter():
    return T.load_counter(T.default_vocabulary())


def test_query_counts_as_the_library(spark, folder, texts, library):
    got = {r["doc_id"]: r for r in T.op2_token_counts(spark, folder).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (got[doc_id]["n_tokens"], got[doc_id]["n_bytes"], got[doc_id]["over_limit"]) == (n, len(text.encode()), n > 1024)


def test_random_texts(counter, library):
    rng = random.Random(5)
    for _ in range(3_000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 25)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_lowest_rank_goes_first_and_leftmost_of_equals():
    counter = T.TokenCounter([("b", "c"), ("a", "b"), ("a", "a"), ("aa", "a")], [])
    assert [counter.merged(w) for w in ("abc", "ab", "aaa", "aaaa", "x", "")] == [2, 1, 1, 2, 1, 0]


def test_very_long_word(counter, library):
    word = "abcdefghij" * 20_000
    assert counter.count(word) == len(library.encode(word, add_special_tokens=False).ids)


def test_memo_of_any_size_gives_the_same(library):
    counter = T.load_counter(T.default_vocabulary())
    counter.of_unit.entries = counter.of_word.entries = 3
    text = "one two, three four; five six seven two one three " * 5
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_rows_columns_and_names(make):
    df = make([(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, " ")], extra=("n_tokens", "_tokens"))
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"], r["_tokens"]) for r in T.count_tokens(df).collect())
    assert got == [(0, 0, 0, False, "x1"), (1, 3, 2, False, "x1"), (1, 3, 2, False, "x1"), (2, 0, 0, False, "x1"), (3, 1, 1, False, "x1")]
    assert T.count_tokens(df.limit(0)).count() == 0
