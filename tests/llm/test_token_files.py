"""Id files against the tokenizers library, and access to single documents."""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from runlens.llm import token_files
from runlens.llm.bpe import vocabulary_path
from runlens.llm.common import shared_folder
from tests.llm import brute

ROWS = "doc_id long, text string"


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]


def written(spark, rows, schema=ROWS):
    folder = shared_folder(spark, "token-files")
    return token_files.write_shards(spark.createDataFrame(rows, schema), folder), folder


@pytest.fixture(scope="module")
def many():
    rng = random.Random(8)
    docs = [(d, t) for d, t in brute.awkward_documents(4)]
    docs += [(5000 + k, brute.prose(rng, rng.randrange(1, 60))) for k in range(400)]
    docs += [(9000, "<|endoftext|> caf\u00e9 \u2603 \U0001f600 naïve" * 3), (-7, "below zero"), (9001, "long " * 60_000)]
    return docs


def test_files_hold_the_librarys_ids_in_order_of_doc_id(spark, many):
    encode = library()
    manifest, _ = written(spark, many)
    assert manifest.count() > 1
    got = {r.doc_id: r for r in token_files.read_back(manifest).collect()}
    assert len(got) == len(many)
    start = 0
    for doc_id, text in sorted(many):
        ids = encode(text)
        r = got[doc_id]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes()
        start += len(ids)


def test_frames_share_a_dictionary_that_is_checked(spark, many):
    manifest, folder = written(spark, many)
    assert os.path.getsize(f"{folder}/dictionary") > 1000
    path = manifest.first().path
    index = token_files.Shard(path).index
    assert (np.diff(index["offset"].astype(int)) == index["length"][:-1]).all()
    with open(f"{folder}/dictionary", "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="dictionary"):
        token_files.Shard(path)


def test_the_dictionary_makes_short_documents_smaller(spark):
    rng = random.Random(3)
    rows = [(k, brute.prose(rng, 25)) for k in range(1500)]
    def size():
        _, folder = written(spark, rows)
        return sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".ids"))
    shared = size()
    old, token_files.LEAST_SAMPLE = token_files.LEAST_SAMPLE, 10**9
    try:
        assert shared < 0.8 * size()
    finally:
        token_files.LEAST_SAMPLE = old


def test_single_documents_are_fetched_by_offset(spark, many):
    encode = library()
    manifest, _ = written(spark, many + [(5003, "a second text of this id")])
    wanted = spark.createDataFrame([(d,) for d in (5003, 5003, -7, 9001, 123456, None)], "doc_id long")
    got = [(r.doc_id, r.ids) for r in token_files.fetch(manifest, wanted).collect()]
    texts = dict(many)
    want = [(5003, encode(texts[5003])), (5003, encode("a second text of this id")), (-7, encode("below zero")), (9001, encode(texts[9001]))]
    assert Counter((d, tuple(i)) for d, i in got) == Counter((d, tuple(i)) for d, i in want)
    assert token_files.fetch(manifest, wanted.limit(0)).count() == 0


def test_missing_ids_repeated_rows_extra_columns_and_empty_tables(spark):
    encode = library()
    rows = [(None, "b"), (None, None), (4, "x y"), (4, "x y"), (4, None), (3, "")]
    plain = spark.createDataFrame([(d, t, 1, "mine") for d, t in rows], ROWS + ", start int, ids string")
    manifest = token_files.write_shards(plain, shared_folder(spark, "token-files"))
    got = token_files.read_back(manifest).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((d, np.array(encode(t), "<u4").tobytes()) for d, t in rows)
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == [None, None, 3, 4, 4, 4]
    assert [r.start for r in by_start] == [0, *np.cumsum([r.n_tokens for r in by_start])[:-1].tolist()]
    none = token_files.write_shards(plain.limit(0), shared_folder(spark, "token-files"))
    assert token_files.read_back(none).count() == 0
    assert token_files.fetch(none, plain.select("doc_id")).count() == 0


def test_a_task_that_is_run_again_leaves_one_whole_shard(spark, many):
    folder = shared_folder(spark, "token-files")
    docs = spark.createDataFrame(many, ROWS)
    first = token_files.write_shards(docs, folder)
    want = sorted((r.doc_id, r.start, zlib.crc32(r.ids)) for r in token_files.read_back(first).collect())
    again = token_files.write_shards(docs, folder)
    assert sorted((r.doc_id, r.start, zlib.crc32(r.ids)) for r in token_files.read_back(again).collect()) == want
    assert all("-" not in f for f in os.listdir(folder))


def test_query_on_the_smallest_tables(spark):
    import __spark_entry__

    sf = "/root/testdata/sf0.001"
    encode = library()
    got = {r.doc_id: r for r in __spark_entry__.queries()["op13_token_files"](spark, sf).collect()}
    start = 0
    for doc_id, text in sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()):
        ids = np.array(encode(text), "<u4")
        assert tuple(got[doc_id])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert start == sum(r.n_tokens for r in got.values())
