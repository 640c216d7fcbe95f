"""The query of op7 counts n-grams of two words, not words alone."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from runlens.llm import importance


def test_query_scores_words_their_ends_and_two_word_runs(spark, tmp_path):
    run, shuffled = "alpha beta gamma delta " * 3, "alpha gamma beta delta " * 3
    texts = {1: run, 2: run, 3: shuffled, 4: "alpha  beta", 5: "alpha", 6: "", 7: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r.score for r in importance.op7_importance(spark, str(tmp_path)).collect()}

    words = {d: (t or "").split() for d, t in texts.items()}
    grams = {d: [("w", w) for w in ws] + [("e", w[-2:]) for w in ws] + [("p", *p) for p in zip(ws, ws[1:])] for d, ws in words.items()}
    kinds = {"w": lambda g: F.xxhash64(F.lit(0), F.lit(g[1])), "e": lambda g: F.xxhash64(F.lit(1), F.lit(g[1])), "p": lambda g: F.xxhash64(F.lit(g[1]), F.lit(g[2]))}
    every = sorted({g for gs in grams.values() for g in gs})
    hashes = spark.range(1).select(*[kinds[g[0]](g).alias(f"h{i}") for i, g in enumerate(every)]).first()
    bin_of = {g: h % importance.BINS for g, h in zip(every, hashes, strict=True)}
    raw = Counter(bin_of[g] for gs in grams.values() for g in gs)
    target = Counter(bin_of[g] for d in (1, 2) for g in grams[d])
    n_raw, n_target = sum(raw.values()), sum(target.values())
    for d, gs in grams.items():
        ratios = [math.log((target[bin_of[g]] + 1) / (n_target + importance.BINS) * (n_raw + importance.BINS) / (raw[bin_of[g]] + 1)) for g in gs]
        assert abs(got[d] - (sum(ratios) / len(ratios) if ratios else 0.0)) < 1e-9
    # The same words in another order are not what the trusted texts say.
    assert got[1] > got[3]
