from __future__ import annotations

import random

import pytest

from runlens.llm import bpe
from tests.llm import brute

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path(bpe.VOCABULARY))


def odd_texts():
    rng = random.Random(2)
    chars = "ab 1\n\t'sl re.<|>é՘　中😀 \x1c\x00İ"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(40))) for _ in range(200)]
    return texts + ["x <|endoftext|>y<|endoftext|>", "<|endoftext|>", "we'll don't  it's ", "೜₏1 a" * 5, "ab" * 3000, "   x   "]


@pytest.mark.parametrize(("words", "chars", "sent"), [(1, 1, 1), (50, 1 << 24, 7), (1 << 18, 3000, 1 << 17), (1 << 18, 1 << 24, 1 << 17)])
def test_same_ids_and_texts_as_the_library(spark, library, monkeypatch, words, chars, sent):
    monkeypatch.setattr(bpe, "PIECE_WORDS", words)
    monkeypatch.setattr(bpe, "PIECE_CHARS", chars)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", sent)
    rows = brute.awkward_documents(3) + [(5000 + k, t) for k, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = bpe.encode(docs, and_decode=True).collect() + bpe.decode(bpe.encode(docs)).collect()
    assert len(got) == 2 * len(rows)
    want = dict(rows)
    for r in got:
        ids = library.encode(want[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids, repr(want[r.doc_id])
        assert r.text == library.decode(ids, skip_special_tokens=False) == (want[r.doc_id] or "")


def test_decode_of_any_ids(spark, library):
    rng = random.Random(4)
    lists = [[rng.randrange(50257) for _ in range(rng.randrange(30))] for _ in range(60)]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lists)] + [(99, None)], "k int, ids array<int>")
    got = {r.k: r.text for r in bpe.decode(df).collect()}
    assert got == {**{k: library.decode(x, skip_special_tokens=False) for k, x in enumerate(lists)}, 99: ""}


def test_missing_ids_repeated_rows_and_extra_columns(spark):
    rows = [(1, "the cat", 5), (1, "the cat", 5), (None, "the cat", 6), (None, None, 7), (1, "a cat", 8)]
    got = bpe.encode(spark.createDataFrame(rows, SCHEMA + ", ids int")).collect()
    assert sorted(len(r.ids) for r in got) == [0, 2, 2, 2, 2]
    assert bpe.encode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_are_not_shuffled_and_no_table_is_left(spark):
    docs = spark.createDataFrame(brute.awkward_documents(3), SCHEMA)
    plan = bpe.encode(docs)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "Scan parquet" in x]
    assert any("Bucketed: true" in x for x in scans)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bpe_")]


def test_many_texts_of_one_id(spark, library):
    texts = [f"qx{k:x} zv" for k in range(5000)]
    got = bpe.decode(bpe.encode(spark.createDataFrame([(1, t) for t in texts], SCHEMA).repartition(6))).collect()
    assert sorted(r.text for r in got) == sorted(texts)
    assert all(r.ids == library.encode(r.text, add_special_tokens=False).ids for r in got)


def test_numbers_are_packed_without_loss():
    for x in ([], [0], [255, 256, 65535, 65536, (1 << 32) - 1], list(range(5000))):
        assert bpe.unpacked(bpe.packed(x)).tolist() == x
