"""Work that must grow no faster than the input: partitions by size, narrow shuffles, joins that are not needed."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from runlens import session
from runlens.operators import metrics, ordering, outcomes, pack, sink
from runlens.plans import datasets, staging
from runlens.sources import frames


@pytest.fixture
def tiny_partitions(monkeypatch):
    """Any stored table is larger than the usual partitions hold."""
    monkeypatch.setattr(session, "PARTITION_BYTES", 64)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def frames_table(spark, tmp_path):
    rows = spark.range(400).select(
        F.expr("id % 4").alias("episode_index"),
        F.expr("id DIV 4").alias("frame_index"),
        F.expr("cast(id AS float) / 10").alias("timestamp"),
        F.expr("IF(id = 398, array(1F), array(1F, cast(id AS float)))").alias("state"),
    )
    rows.write.parquet(str(tmp_path / "frames"))
    return spark.read.parquet(str(tmp_path / "frames"))


def test_uneven_lists_are_looked_for_once(spark, frames_table):
    samples, issues = pack.pack_frames(frames_table, ["state"])
    # Found and stored before: reading samples again does not count lengths again.
    assert "Window" not in plan_of(samples)
    assert samples.count() == 300 and [r["item"] for r in issues.collect()] == ["state"]


def test_ranges_follow_the_size_of_the_input(spark, frames_table, tiny_partitions):
    dealt = ordering.deal_in_order(frames_table, ["episode_index"], ["frame_index"])
    assert dealt.select("_part").distinct().count() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = ordering.number_rows(frames_table, ["episode_index"], ["frame_index"])
    assert numbered.where("step <> frame_index").count() == 0 and numbered.count() == 400


def test_commits_are_dealt_by_size(spark, frames_table, tiny_partitions, tmp_path):
    samples, _ = pack.pack_frames(frames_table, ["state"])
    sink.commit(samples, str(tmp_path / "out"), "all", cluster_by=["episode_id", "step"])
    stored = sink.committed(spark, str(tmp_path / "out"), samples.schema)
    assert len(stored.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert stored.count() == 300


def test_no_hash_is_shuffled_where_all_columns_decide(spark, monkeypatch):
    monkeypatch.setattr(ordering, "row_hash", lambda df: F.raise_error(F.lit("hashed")))
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "a"), (1, 4, "b"), (2, 9, "c")], "g BIGINT, o BIGINT, s STRING")
    got = ordering.number_rows(rows, ["g"], ["o", "s"]).collect()
    assert sorted((r["g"], r["o"], r["s"], r["step"]) for r in got) == [(1, 4, "b", 0), (1, 5, "a", 1), (1, 5, "a", 2), (2, 9, "c", 0)]


def test_distances_of_large_inputs_are_dealt_by_size(spark, tiny_partitions, tmp_path):
    made = "id % 3 AS episode_id, '/cmd_vel/linear' AS key, id DIV 3 AS step, array(cast(id AS double)) AS value"
    spark.range(90).selectExpr(*made.split(", ")).write.parquet(str(tmp_path / "s"))
    base = spark.read.parquet(str(tmp_path / "s"))
    cand = base.withColumn("value", F.transform("value", lambda x: x + 2.0))
    out = metrics.action_l2(base, cand)
    assert "REPARTITION_BY_NUM" in plan_of(out)
    assert {r["episode_id"]: r["action_l2"] for r in out.collect()} == {0: 2.0, 1: 2.0, 2: 2.0}


def test_frame_files_are_listed_by_folder(spark, frames_table, tmp_path):
    parts = {(0, 1): 0, (0, 2): 1, (1, 2): 2, (0, 3): 3}
    for (chunk, episode), k in parts.items():
        rows = frames_table.where(F.col("episode_index") == k).toPandas()
        path = tmp_path / "data" / f"chunk-{chunk:03d}" / f"episode_{episode:06d}.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        rows.to_parquet(path)
    (tmp_path / "data" / "chunk-000" / "notes.txt").write_text("no frames")
    got = frames.scan_frames_v2(spark, str(tmp_path))
    assert "InMemoryFileIndex(2 paths)" in plan_of(got)
    # Episode 2 lies in two chunks; the one of its thousand stays.
    assert {r["episode_index"]: r["count"] for r in got.groupBy("episode_index").count().collect()} == {1: 100, 2: 100, 3: 100}


def test_demo_steps_store_what_is_read(spark):
    steps = datasets._demo_steps(spark, "/root/testdata/sf0.001")
    stored = {f.name for f in spark.read.parquet(*steps.inputFiles()).schema.fields}
    assert not stored & {"path", "demo", "l_orderkey", "l_shipdate", "l_returnflag"}
    assert {r["demo"] is None for r in steps.where("single").select("demo").distinct().collect()} == {True}


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_last_rows_are_marked_across_partitions(spark, monkeypatch, parts):
    monkeypatch.setattr(ordering, "partitions_by_size", lambda df: [parts])
    rows = spark.range(500).selectExpr("IF(id < 300, 0, id % 40) AS g", "id AS o")
    got = ordering.number_rows(rows, ["g"], ["o"], last="done").collect()
    ends = {}
    for r in got:
        ends[r["g"]] = max(ends.get(r["g"], -1), r["o"])
    assert all(r["done"] == (ends[r["g"]] == r["o"]) for r in got) and len(got) == 500


def test_outcomes_of_numbers_sort_nothing(spark):
    rows = [(1, 0, 5.0, False), (1, 1, 7.0, True), (2, 0, None, True)]
    made = spark.createDataFrame(rows, "e BIGINT, i BIGINT, `next.reward` DOUBLE, `next.done` BOOLEAN")
    out = outcomes.frame_outcomes(made, ["next.reward", "next.done"], "e", "i")
    assert "Sort" not in plan_of(out)
    got = {r["e"]: (r["outcome"]["next.reward"], r["outcome"]["next.done"], r["reward_sum"]) for r in out.collect()}
    assert got == {1: (7.0, True, 12.0), 2: (None, True, None)}


def test_text_files_share_folders(spark, tmp_path):
    rows = spark.range(60).selectExpr("id % 3 + 999 AS g", "-id AS at", "concat('é ', id) AS line")
    staging.text_files(rows, str(tmp_path / "t"), "g", "at")
    found = sorted(str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").rglob("*.txt"))
    assert found == ["part-000/g=999.txt", "part-001/g=1000.txt", "part-001/g=1001.txt"]
    text = (tmp_path / "t" / "part-001" / "g=1000.txt").read_text()
    assert text == "".join(f"é {i}\n" for i in range(58, 0, -3))


def test_messages_meet_the_verdict_of_their_topic_once(spark):
    entry = "array<struct<field:string,value:array<float>,scalar:boolean>>"
    rows = [
        ("r", "/a", "T", 20, 2, [("x", [1.0], True), ("y", [1.0, 2.0], False)], None),
        ("r", "/a", "T", 10, 1, [("x", [3.0], True), ("y", [1.0], False)], None),
        ("r", "/a", "T", 15, 3, [], None),
        ("r", "/b", "T", 10, 4, [("x", [1.0], True)], None),
        ("r", "/b", "T", 11, 5, [], "x missing"),
        # A scalar and a vector of one number have different shapes.
        ("r", "/c", "T", 10, 6, [("x", [1.0], True), ("z", [4.0], True)], None),
        ("r", "/c", "T", 11, 7, [("x", [1.0], False), ("z", [5.0], True)], None),
    ]
    kind = f"recording_id STRING, topic STRING, msgtype STRING, t_ns BIGINT, seq BIGINT, fields {entry}, failed STRING"
    flat = spark.createDataFrame(rows, kind).withColumn("pos", F.struct("t_ns", "seq"))
    out = pack.pack_messages(flat)
    assert "SortAggregate" not in plan_of(out)
    got = sorted((r["key"], r["step"], r["t_ns"], r["value"]) for r in out.collect())
    assert got == [("/a/x", 0, 10, [3.0]), ("/a/x", 1, 20, [1.0]), ("/c/z", 0, 10, [4.0]), ("/c/z", 1, 11, [5.0])]
