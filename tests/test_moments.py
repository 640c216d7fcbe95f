from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from runlens.operators.moments import vector_moments


def test_moments_equal_numpy_for_hot_and_small_groups(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(3000):
        ep = 0 if k % 3 == 0 else int(rng.integers(1, 40))
        width = 4 if ep % 2 == 0 else int(rng.integers(0, 6))
        rows.append((ep, f"k{k % 2}", [float(x) for x in rng.normal(1e6, 1e-3, width)]))
    rows += [(77, "k", [1.0, None]), (77, "k", [float("nan"), 2.0]), (77, "k", None), (None, "k", [5.0])]
    df = spark.createDataFrame(rows, "ep INT, key STRING, value ARRAY<DOUBLE>").repartition(9)
    found = vector_moments(df, ["ep", "key"], "value")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = {(r.ep, r.key): r for r in found.collect()}
    groups = {}
    for ep, key, value in rows[:3000]:
        groups.setdefault((ep, key), []).append(value)
    for key, vectors in groups.items():
        width = max(map(len, vectors))
        if not width:
            assert key not in got
            continue
        for d in range(width):
            x = np.array([v[d] for v in vectors if len(v) > d])
            r = got[key]
            assert (r.n[d], r.m[d]) == (len(x), len(x))
            assert np.isclose(r["mean"][d], x.mean(), rtol=1e-14) and np.isclose(np.sqrt(r.m2[d] / r.m[d]), x.std(), rtol=1e-6)
    assert got[77, "k"].n == [2, 2] and got[77, "k"].m == [2, 1]
    assert np.isnan(got[77, "k"]["mean"][0]) and got[77, "k"]["mean"][1] == 2.0
    assert got[None, "k"]["mean"] == [5.0]
    assert vector_moments(df.where(F.lit(False)), ["ep", "key"], "value").count() == 0


def test_moments_of_many_batches_under_keys_that_cannot_be_null(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = spark.range(0, 40, 1, 8).select(
            (F.col("id") % 2).alias("episode_id"), F.lit("/arm").alias("key"), F.array(F.col("id").cast("double")).alias("value")
        )
        assert not rows.schema["key"].nullable
        found = {r["episode_id"]: r for r in vector_moments(rows, ["episode_id", "key"], "value").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {k: (r["n"], r["mean"]) for k, r in found.items()} == {0: ([20], [19.0]), 1: ([20], [20.0])}
    assert all(abs(r["m2"][0] - 2660.0) < 1e-6 for r in found.values())
