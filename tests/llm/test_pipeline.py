import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tallyhouse.llm import language_id as L
from tallyhouse.llm import packing, secret_scans
from test_decontamination import brute as brute_items
from test_language_id import plain_model, plain_prediction
from test_packing import check_sequences
from test_secret_scans import brute as brute_secrets
from test_simhash import brute_groups

HEX = "0123456789abcdef" * 3


def test_registered():
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing",
    ]
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def rows_of(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_every_stage_against_brute_force(spark, folder, docs, tmp_path):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    now, before = docs, rows_of(docs)
    settings, seen = L.Settings(), {}
    teach = [(r["text"], r["lang"]) for i, r in before.items() if zlib.crc32(str(i).encode()) % 4 != 2 and r["lang"] and r["text"]]
    assert max(Counter(lang for _, lang in teach).values()) < settings.rows_per_language  # all of them are the sample
    model = plain_model(teach, settings)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, now, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{number}")
        now = spark.read.parquet(f"{tmp_path}/{number}")
        after = rows_of(now)
        assert now.count() == len(after)
        if name == "language_id":
            found = {i: plain_prediction(model, r["text"], settings, seen) for i, r in before.items()}
            want = {i for i, (lang, score) in found.items() if lang != "und" and score >= 0.5}
        elif name == "simhash_near_dedup":
            want = {i for i, c in brute_groups({i: r["text"] for i, r in before.items()})[1].items() if i == c}
            assert len(want) < len(before)
        elif name == "benchmark_decontamination":
            want = set(before) - {f[0] for f in brute_items([(i, r["text"]) for i, r in before.items()], bench)}
            assert len(want) < len(before)
        else:
            want = set(before)
            changed = [i for i in want if after[i]["text"] != before[i]["text"]]
            assert set(changed) == {i for i in want if brute_secrets(before[i]["text"])} and changed
            assert all(secret_scans.MASK in after[i]["text"] and after[i]["n_chars"] == len(after[i]["text"]) for i in changed)
        assert set(after) == want
        if name != "secret_scans":
            assert all(after[i] == before[i] for i in after)
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, now, folder).collect()
    check_sequences(last)
    assert {r["doc_id"] for r in last} == set(before)
    run = corpus_pipeline.run(spark, folder).collect()
    pieces = lambda rows: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert pieces(run) == pieces(last)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, folder, make, name, stage):
    teach = [(100 + i, "the and of to in that is was he for", "en") for i in range(8)]
    rows = [*teach, (1, None), (2, ""), (3, "the and of" + " word" * 50_000), (None, "of the and to"), (4, f"the token={HEX} and"), (4, f"the token={HEX} and")]
    df = make(rows, extra=("score", "fp", "blob", "spans", "size", "seq", "_key"))
    out = stage(spark, df, folder)
    kept = out.collect()
    if name == "best_fit_packing":
        assert len({(r["doc_id"], r["sequence_id"], r["offset"]) for r in kept}) == len(kept)
        check_sequences(kept)
    else:
        assert out.columns == df.columns and {r["_key"] for r in kept} == {"x6"}
    if name == "language_id":
        assert sorted(r["doc_id"] or 0 for r in kept) == [0, 3, 4, 4, *range(100, 108)]
    if name == "simhash_near_dedup":
        assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 3, 4, 100]
    if name == "secret_scans":
        assert len(kept) == len(rows) and not any(HEX in (r["text"] or "") for r in kept)
    empty = stage(spark, df.limit(0), folder)
    assert empty.count() == 0 and empty.columns == out.columns


def test_packing_is_of_the_whole_text(spark, make):
    rows = corpus_pipeline.packed(spark, make([(1, "a b c " * 5_000)]), "").collect()
    assert sum(r["length"] for r in rows) == 15_001 and max(r["length"] for r in rows) == packing.CAPACITY
