from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.operators import ordering

HOT = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, with ties and outliers in the order column."""
    rng = np.random.default_rng(3)
    groups = np.concatenate([np.zeros(HOT, dtype=int), rng.integers(1, 200, 2 * HOT)])
    order = rng.integers(0, 5000, 3 * HOT)
    order[:5] = [10**15, 0, 0, 10**15, 1]
    rows = [(int(g), int(o), i) for i, (g, o) in enumerate(zip(groups, order))]
    return spark.createDataFrame(rows, "g BIGINT, o BIGINT, id BIGINT").cache()


def expected(df):
    rows = sorted((r["g"], r["o"], r["id"]) for r in df.collect())
    out, last, pos, prev = {}, None, 0, None
    for g, o, i in rows:
        if g != last:
            last, pos, prev = g, 0, None
        out[i] = (pos, prev)
        pos, prev = pos + 1, o
    return out


@pytest.fixture(params=[1, 7, 60])
def parts(request, spark):
    """Range partitions of any number, also such that hold a piece of one group only."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def test_positions_do_not_depend_on_partitions(skewed, parts):
    want = expected(skewed)
    numbered = ordering.number_rows(skewed, ["g"], ["o", "id"])
    assert numbered.columns == ["g", "o", "id", "step"]
    assert {r["id"]: r["step"] for r in numbered.collect()} == {i: v[0] for i, v in want.items()}


def test_previous_values_cross_partitions(skewed, parts):
    want = expected(skewed)
    got = ordering.previous_value(skewed, ["g"], ["o", "id"], "o", "prev")
    assert {r["id"]: r["prev"] for r in got.collect()} == {i: v[1] for i, v in want.items()}


def test_running_xor_crosses_partitions(skewed, parts):
    rows = sorted((r["g"], r["o"], r["id"]) for r in skewed.collect())
    want, last, bits = {}, None, 0
    for g, o, i in rows:
        bits = (0 if g != last else bits) ^ (o * 31 + i)
        last, want[i] = g, bits
    df = skewed.withColumn("h", F.col("o") * 31 + F.col("id"))
    got = ordering.running_xor(df, ["g"], ["o", "id"], {"h": "x"})
    assert got.columns == ["g", "o", "id", "h", "x"]
    assert {r["id"]: r["x"] for r in got.collect()} == want


def test_a_hot_group_spreads_and_is_shuffled_once(skewed, parts):
    dealt = ordering.deal_in_order(skewed, ["g"], ["o", "id"])
    sizes = [r["count"] for r in dealt.groupBy("_part").count().collect()]
    assert len(sizes) >= min(parts, 7) and max(sizes) <= max(3 * HOT / parts * 3, 300)
    numbered = ordering.number_rows(skewed, ["g"], ["o", "id"])
    assert "Exchange hash" not in numbered._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz", "double", "struct<a:int,b:string>"])
def test_any_sortable_type_gives_the_order(spark, parts, kind):
    rows = spark.range(600).select(F.expr("id % 3").alias("g"), F.expr("CASE WHEN id % 50 <> 7 THEN (id * 37) % 600 END").cast("int").alias("n"))
    made = {
        "string": "lpad(cast(n AS string), 4, '0')",
        "date": "date_add(DATE'2020-01-01', n)",
        "timestamp_ntz": "cast(date_add(DATE'2020-01-01', n) AS timestamp_ntz)",
        "double": "n / 7.0D",
        "struct<a:int,b:string>": "IF(n IS NULL, NULL, struct(n DIV 10 AS a, cast(n % 10 AS string) AS b))",
    }
    df = rows.withColumn("o", F.expr(made[kind]))
    got = ordering.previous_value(ordering.number_rows(df, ["g"], ["o"]), ["g"], ["o"], "o", "p")
    seen = {}
    for r in got.collect():
        seen.setdefault(r["g"], []).append((r["step"], r["n"], r["o"], r["p"]))
    for g in seen.values():
        g.sort(key=lambda r: r[0])
        assert [r[0] for r in g] == list(range(200))
        numbers = [-1 if r[1] is None else r[1] for r in g]
        assert numbers == sorted(numbers)
        filled = [r for r in g if r[1] is not None]
        assert all(b[3] == a[2] for a, b in zip(filled, filled[1:]))


def test_ties_nulls_and_empty_tables(spark, parts):
    tied = spark.createDataFrame([(None, 1, x % 5) for x in range(40)] + [("a", None, 0)] * 3, "g STRING, o INT, x INT")
    steps = ordering.number_rows(tied, ["g"], ["o"])
    assert sorted(r["step"] for r in steps.where("g IS NULL").collect()) == list(range(40))
    assert sorted(r["step"] for r in steps.where("g = 'a'").collect()) == [0, 1, 2]
    assert ordering.number_rows(tied.limit(0), ["g"], ["o"]).count() == 0
    assert ordering.previous_value(tied.limit(0), ["g"], ["o"], "x", "p").columns == ["g", "o", "x", "p"]


def test_median_equals_numpy(spark):
    rng = np.random.default_rng(5)
    data = {g: rng.integers(1, 10 ** int(rng.integers(1, 12)), int(rng.integers(1, 60))) for g in range(40)}
    data[99] = np.full(1000, 33_333_333)
    rows = [(g, int(v)) for g, vs in data.items() for v in vs] + [(1, 0), (1, -5)]
    df = spark.createDataFrame(rows, "g BIGINT, v BIGINT")
    got = {r["g"]: r["m"] for r in ordering.grouped_median(df, ["g"], "v", "m").collect()}
    assert got == {g: float(np.median(v)) for g, v in data.items()}


def test_salted_join_keeps_every_row(spark, skewed):
    small = spark.range(0, 100).withColumnRenamed("id", "g").withColumn("x", F.col("g") * 2)
    joined = ordering.salted_join(skewed, small, ["g"], F.col("id"), how="left")
    assert joined.count() == skewed.count()
    assert joined.where("x <> g * 2").count() == 0
    semi = ordering.salted_join(skewed, small, ["g"], F.col("id"), how="left_semi")
    assert semi.count() == skewed.where("g < 100").count()


def test_small_side_of_a_salted_join_is_estimated_with_its_salts(spark):
    """Below the broadcast limit as it stands, sixteen times as large when salted."""
    small = spark.range(0, 100_000).select(F.col("id").alias("g"), F.lit(True).alias("x"))
    big = spark.range(0, 20_000_000).select((F.col("id") % 7).alias("g"), F.col("id").alias("step"))
    plan = ordering.salted_join(big, small, ["g"], F.col("step"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_plan_of_requests_sends_no_ids_through_the_driver(spark):
    from runlens.operators import catalog

    asked = spark.createDataFrame([(1, " 5"), (2, "#5"), (3, "  "), (4, "9999999"), (5, "5 ")], "pos BIGINT, token STRING")
    found = catalog.eval_plan(asked, spark.range(0, 100_000).withColumnRenamed("id", "episode_id"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["pos"], r["baseline_episode_id"], r["known"]) for r in found.collect())
    assert got == [(1, "5", True), (4, "9999999", False), (5, "5", True)]


def test_only_kept_columns_are_stored_with_a_position(spark):
    rows = [(k % 5, k * 37 % 101, f"text {k}", k) for k in range(300)]
    df = spark.createDataFrame(rows, "g INT, o INT, wide STRING, v INT")
    got = ordering.number_rows(df, ["g"], ["o", "v"], keep=["g", "v"])
    assert got.columns == ["g", "v", "step"]
    want = {(g, v, k) for x in range(5) for k, (g, _, _, v) in enumerate(sorted((r for r in rows if r[0] == x), key=lambda r: (r[1], r[3])))}
    assert set(map(tuple, got.collect())) == want
