from __future__ import annotations

import random

import pytest

import corpus_pipeline
from runlens.llm import bpe, importance
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    good = [brute.prose(rng, 150) for _ in range(40)]
    passage = brute.prose(rng, 60)
    leak = brute.prose(rng, 30)
    texts = [
        *good,
        good[0],
        brute.edited(rng, good[1], 3),
        brute.prose(rng, 60) + " " + passage + " " + brute.prose(rng, 60),
        brute.prose(rng, 60) + " " + passage + " " + brute.prose(rng, 60),
        brute.prose(rng, 60) + " " + leak + " " + brute.prose(rng, 60),
        " ".join(w + "%%%" for w in brute.prose(rng, 150).split()),
        "too short",
        None,
        "",
    ]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    write(docs, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write([(k, int(k != 45), 0) for k in range(46)], "doc_id long, quality int, toxic int", "labels")
    write([(1, leak), (2, "never seen anywhere at all")], "item_id long, text string", "benchmark")
    return path, docs


def test_stages_take_effect(spark, folder):
    path, docs = folder
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    # Kept: all good ones; 40 and 41 are copies, 44 holds a leak, 45 is junk, the rest is short or empty.
    assert sorted(rows) == [*range(40), 42, 43]
    assert all(rows[k].text == docs[k][1] for k in [*range(40), 42])
    assert len(rows[43].text) < len(docs[43][1]) - 200
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path(bpe.VOCABULARY))
    assert all(r.ids == library.encode(r.text, add_special_tokens=False).ids for r in rows.values())


def test_every_stage_but_the_last_returns_documents(spark, folder):
    docs = corpus_pipeline.table(spark, folder[0], "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder[0]), f"test-{name}")
        assert docs.columns[: len(COLUMNS)] == COLUMNS
        assert name == "bpe" or docs.columns == COLUMNS


def test_stages_on_an_empty_table(spark, folder):
    empty = corpus_pipeline.table(spark, folder[0], "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder[0]).count() == 0


def brute_base(text):
    words = importance_words(text)
    lines = [x for x in (text or "").split("\n") if importance_words(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


def importance_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_figures_and_score(spark, folder):
    import math

    import xxhash

    path, docs = folder
    rng = random.Random(6)
    loop = brute.prose(rng, 20)
    more = [(100 + k, t) for k, t in enumerate([loop + "\n" + loop + "\n" + brute.prose(rng, 60), "a b " * 40, "x\n\nx\n x\nx", "é\x0b#ü |>\t<"])]
    more += [r for r in brute.awkward_documents(2) if len(r[1] or "") < 3000]
    # Running numbers: the plain version keeps texts by id.
    base = [(d[0], d[1]) for d in docs] + [(5000 + i, t) for i, (_, t) in enumerate(more)]
    df = spark.createDataFrame(base, "doc_id long, text string")
    labels = corpus_pipeline.table(spark, path, "labels")
    got = {r.doc_id: r for r in importance.score(df, labels).collect()}
    # Bins: Spark's 64-bit hash of a number and a string, modulo the number of bins.
    to_long = lambda x: x - (1 << 64) if x >> 63 else x

    def hashed(k, s):
        seed = xxhash.xxh64_intdigest  # strings are hashed with the number's hash as the seed
        return to_long(seed(s.encode(), seed=int_hash(k))) % importance.BINS

    def int_hash(k):
        m = (1 << 64) - 1
        rot = lambda x, r: ((x << r) | (x >> (64 - r))) & m
        p1, p2, p3, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5
        h = (42 + p5 + 4) & m
        h ^= (k * p1) & m
        h = (rot(h, 23) * p2 + p3) & m
        h ^= h >> 33
        h = h * p2 & m
        h ^= h >> 29
        h = h * p3 & m
        return h ^ (h >> 32)

    bins = {d: [hashed(k, s) for w in importance_words(t) for k, s in ((0, w), (1, w[-2:]))] for d, t in base}
    trusted = {k for k in range(46) if k != 45}
    raw, target = [0] * importance.BINS, [0] * importance.BINS
    for d, bs in bins.items():
        for b in bs:
            raw[b] += 1
            target[b] += d in trusted
    n_raw, n_target = sum(raw), sum(target)
    for d, t in base:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(t), repr(t)
        ratio = [math.log((target[b] + 1) / (n_target + importance.BINS) / ((raw[b] + 1) / (n_raw + importance.BINS))) for b in bins[d]]
        want = sum(ratio) / len(ratio) if ratio else 0.0
        assert abs(r.score - want) < 1e-9
        assert r.kept == (not r.base_failed and r.score >= importance.THRESHOLD)


def test_quality_without_trusted_rows(spark, folder):
    docs = corpus_pipeline.table(spark, folder[0], "documents")
    none = corpus_pipeline.table(spark, folder[0], "labels").limit(0)
    assert {(r.kept, r.score) for r in importance.score(docs, none).filter("NOT base_failed").collect()} == {(True, 0.0)}


def test_all_trusted_documents_count_however_often_labelled(spark, folder):
    from pyspark.sql import functions as F

    docs = corpus_pipeline.table(spark, folder[0], "documents")
    labels = corpus_pipeline.table(spark, folder[0], "labels")
    # Labels that stand first by hashed id: many of one document, and many of documents that are absent.
    first = labels.filter("quality = 1").orderBy(F.xxhash64("doc_id")).first().doc_id
    lit = lambda x: F.lit(x).cast("int")
    more = spark.range(25_000).select(F.lit(first).alias("doc_id"), lit(1).alias("quality"), lit(0).alias("toxic"))
    absent = spark.range(1000, 61_000).select(F.col("id").alias("doc_id"), lit(1).alias("quality"), lit(0).alias("toxic"))
    want = importance.log_ratios(docs, labels).first().ratios
    assert importance.log_ratios(docs, labels.union(more)).first().ratios == want
    assert importance.log_ratios(docs, labels.union(absent)).first().ratios == want
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert set(importance.log_ratios(nameless, labels).first().ratios) == {0.0}


def test_rows_of_one_id_are_all_counted_and_judged(spark, folder):
    docs = corpus_pipeline.table(spark, folder[0], "documents").select("doc_id", "text")
    labels = corpus_pipeline.table(spark, folder[0], "labels")
    twice = docs.union(docs.filter("doc_id = 3")).union(docs.filter("doc_id = 4").selectExpr("3L", "text"))
    once = {r.doc_id: r.n_words for r in importance.score(docs, labels).collect()}
    rows = [r.n_words for r in importance.score(twice, labels).filter("doc_id = 3").collect()]
    assert sorted(rows) == sorted([once[3], once[3], once[4]])
    raw = importance.log_ratios(twice, labels).first().ratios
    assert raw != importance.log_ratios(docs, labels).first().ratios


def test_quality_replaces_columns_of_its_own_names(spark, folder):
    docs = corpus_pipeline.table(spark, folder[0], "documents").select("doc_id", "text")
    labels = corpus_pipeline.table(spark, folder[0], "labels")
    clashing = docs.selectExpr("*", "'x' AS score", "7 AS kept", "1 AS n_words", "'mine' AS extra")
    got = importance.score(clashing, labels)
    assert got.columns.count("score") == got.columns.count("kept") == 1
    want = importance.score(docs, labels).select("doc_id", "n_words", "score", "kept")
    assert got.filter("extra = 'mine'").select(*want.columns).exceptAll(want).count() == 0


def test_the_quality_stage_computes_each_figure_once(spark, folder):
    """A filter above the scoring must not copy its expressions."""
    docs = corpus_pipeline.table(spark, folder[0], "documents")
    labels = corpus_pipeline.table(spark, folder[0], "labels")
    plan = importance.keep_good(spark, docs, folder[0])._jdf.queryExecution().optimizedPlan().toString()
    scored = importance.score(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") <= scored.count("xxhash64")
    assert plan.count("split(") <= scored.count("split(")
