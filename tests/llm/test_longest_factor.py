from __future__ import annotations

import hashlib
import random

import pytest

from runlens.llm import longest_factor
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def result(df, width, keep_first=False):
    rows = longest_factor.remove_repeats(df, width, keep_first).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept_bytes).hexdigest()) for r in rows}


@pytest.mark.parametrize("width", [24, 61, 200])
def test_same_bytes_as_counting_all_strings(spark, width):
    rows = brute.awkward_documents(8)
    rng = random.Random(3)
    rows += [(9000 + k, "ab" * rng.randrange(5, 200)) for k in range(6)] + [(9100, "é" * 333), (9101, "xé" * 200)]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(4), width) == brute.repeated_bytes(rows, width)


def test_given_table(spark):
    df = longest_factor.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    assert result(df, 200) == brute.repeated_bytes([tuple(r) for r in df.collect()], 200)


def test_chunks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(longest_factor, "CHUNK", 64)
    rows = brute.awkward_documents(4)
    assert result(spark.createDataFrame(rows, SCHEMA), 30) == brute.repeated_bytes(rows, 30)


def first_kept(rows, width):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            s = data[i : i + width]
            if s in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(s)
        out[d] = bytes(c for c, g in zip(data, gone) if not g)
    return out


def test_first_copy_stays(spark):
    rows = [r for r in brute.awkward_documents(8)]
    got = longest_factor.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), 40, True).collect()
    assert {r.doc_id: bytes(r.kept_bytes) for r in got} == first_kept(rows, 40)


def test_missing_ids_repeated_rows_and_extra_columns(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(50)) * 9
    rows = [(1, text, 1), (1, text, 1), (None, text, 2), (2, None, 3), (3, "short", 4)]
    df = spark.createDataFrame(rows, SCHEMA + ", n_bytes int")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in longest_factor.remove_repeats(df, 200, False).collect())
    assert got == [(0, 450, 450), (1, 450, 450), (1, 450, 450), (2, 0, 0), (3, 5, 0)]
    assert longest_factor.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert longest_factor.keep_first_copies(spark, df.filter("doc_id > 1"), "").count() == 2
