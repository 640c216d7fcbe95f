from __future__ import annotations

import random

import pytest

from runlens.llm import near_dup
from runlens.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()}


@pytest.mark.parametrize("seed", [5, 6])
def test_same_components_as_all_pairs(spark, seed):
    rows = brute.awkward_documents(seed)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute.near_duplicates(rows)


def test_star_of_copies_that_are_not_linked_with_each_other(spark):
    rng = random.Random(9)
    centre = brute.prose(rng, 200)
    rows = [(i, brute.edited(rng, centre, 4)) for i in range(60)] + [(500, centre)]
    want = brute.near_duplicates(rows)
    assert result(spark.createDataFrame(rows, SCHEMA)) == want


@pytest.mark.parametrize("seed,words", [(1, 60), (2, 150), (3, 30)])
def test_many_copies_around_the_threshold(spark, seed, words):
    """Independent edits, edits of edits, cut and grown copies: some linked with the original, some with each other."""
    rng = random.Random(seed)
    base = brute.prose(rng, words)
    texts = [base] + [brute.edited(rng, base, max(1, round(words * rng.uniform(0.01, 0.08)))) for _ in range(60)]
    for _ in range(60):
        t = brute.edited(rng, rng.choice(texts), rng.randrange(1, 4))
        w = t.split(" ")
        cut = rng.randrange(0, max(1, len(w) // 6))
        texts += [" ".join(w[cut:]), t + " " + brute.prose(rng, cut)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    want = brute.near_duplicates(rows)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3)) == want
    assert len({c for _, c, _ in want.values()}) > 3


def test_given_table(spark):
    df = near_dup.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    assert result(df) == brute.near_duplicates([tuple(r) for r in df.collect()])


def test_missing_ids_repeated_rows_and_extra_columns(spark):
    text = "a b c d e f g h"
    rows = [(None, text, 1), (4, text, 2), (4, text, 2), (2, text.upper(), 3), (None, "x y z", 4), (7, None, 5)]
    df = spark.createDataFrame(rows, SCHEMA + ", kept int")
    got = sorted(near_dup.near_duplicates(df).collect(), key=str)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(2, 2, True), (4, 2, False), (4, 2, False), (7, 7, True)]
    assert {(r.component_id, r.kept) for r in got if r.doc_id is None} == {(2, False), (None, True)}
    kept = near_dup.keep_one(spark, df, "").collect()
    assert sorted(r.kept for r in kept) == [3, 4, 5]


def test_a_third_without_ids(spark):
    """Components are those of the table with all ids; the id is the least that is left."""
    rows = brute.awkward_documents(7)
    whole = brute.near_duplicates(rows)
    gone = {d for k, (d, _) in enumerate(sorted(rows)) if k % 3 == 0}
    marked = [(None if d in gone else d, d, t) for d, t in rows]
    df = spark.createDataFrame(marked, "doc_id long, place long, text string").repartition(4)
    least: dict = {}
    for d, (_, c, _) in whole.items():
        if d not in gone:
            least[c] = min(d, least.get(c, d))
    got = near_dup.keyed_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {
        d: least[c] for d, (n, c, _) in whole.items() if d not in gone
    }
    left = near_dup.keep_one(spark, df, "").collect()
    with_words = [whole[r.place][1] for r in left if whole[r.place][0]]
    assert sorted(with_words) == sorted({c for n, c, _ in whole.values() if n})
    assert sorted(r.place for r in left if not whole[r.place][0]) == sorted(d for d, (n, _, _) in whole.items() if not n)
    assert all(r.doc_id == least[whole[r.place][1]] for r in left if whole[r.place][0] and whole[r.place][1] in least)


def test_ids_above_the_keys_of_rows_without_ids(spark):
    text = "a b c d e f g h"
    rows = [((1 << 63) - 2, text), (None, text), ((1 << 63) - 1, text.upper()), (None, "x y z"), (None, "x y z"), (-5, "q")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {
        ((1 << 63) - 2, (1 << 63) - 2, True), (None, (1 << 63) - 2, False), ((1 << 63) - 1, (1 << 63) - 2, False),
        (None, None, True), (-5, -5, True),
    }
    assert near_dup.keep_one(spark, spark.createDataFrame(rows, SCHEMA), "").count() == 3


def test_columns_named_like_added_ones_stay(spark):
    rows = [(k, "a b c d e f", k + 1, "x", True, 8, 9) for k in (1, 1, 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", _key int, _text string, kept boolean, n_shingles int, repeated int")
    assert [tuple(r) for r in near_dup.keep_one(spark, df, "").collect()] == [(1, "a b c d e f", 2, "x", True, 8, 9)]


def test_repeats_under_one_id(spark):
    rows = [(1, "a b c d e f")] * 5 + [(1, "another text of the same id")] + [(2, None)] * 2
    left = near_dup.keep_one(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted((r.doc_id, r.text or "") for r in left) == [(1, "a b c d e f"), (1, "another text of the same id"), (2, ""), (2, "")]


def test_empty_table(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == {}


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (1, 0)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}}
