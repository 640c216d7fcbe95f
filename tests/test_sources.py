from __future__ import annotations

import json
import os
import pathlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from runlens.functions import outcome, scalars, typed
from runlens.sources import arrays, demos, frames


def frame_file(root, chunk, episode, rows, mark):
    path = root / f"data/chunk-{chunk:03d}/episode_{episode:06d}.parquet"
    os.makedirs(path.parent, exist_ok=True)
    pd.DataFrame({"frame_index": range(rows), "mark": [mark] * rows}).to_parquet(path)


def test_one_file_per_episode_prefers_chunks_of_1000(spark, tmp_path):
    frame_file(tmp_path, 0, 0, 5, "only")
    frame_file(tmp_path, 0, 250, 3, "thousand")
    frame_file(tmp_path, 2, 250, 9, "hundred")
    frame_file(tmp_path, 3, 301, 2, "old")
    df = frames.scan_frames_v2(spark, str(tmp_path))
    got = {(r["episode_index"], r["mark"]): r["count"] for r in df.groupBy("episode_index", "mark").count().collect()}
    assert got == {(0, "only"): 5, (250, "thousand"): 3, (301, "old"): 2}


def test_shards_are_sliced_by_a_pushed_filter(spark, tmp_path):
    spark.range(20).selectExpr("id % 4 AS episode_index", "id AS frame_index").write.parquet(str(tmp_path / "data"))
    shards = frames.scan_frames_v3(spark, str(tmp_path))
    part = frames.slice_episodes(shards, [1, 9])
    assert part.count() == 5
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(episode_index" in plan
    want = spark.createDataFrame([(1,), (9,)], "episode_index BIGINT")
    assert [r[0] for r in frames.empty_episodes(want, shards).collect()] == [9]
    with pytest.raises(ValueError):
        frames.slice_episodes(shards.drop("episode_index"), [1])


def test_a_table_of_wanted_episodes_reads_only_their_row_groups(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 1).selectExpr("id DIV 200 AS episode_index", "id AS frame_index", "cast(id AS string) AS pad")
    rows.write.option("parquet.block.size", 1 << 17).parquet(str(tmp_path / "data"))
    shards = frames.scan_frames_v3(spark, str(tmp_path))
    wanted = spark.createDataFrame([(3,), (4,), (990,), (990,), (5000,), (None,)], "episode_index BIGINT")
    part = frames.slice_episodes(shards, wanted)
    assert {(r[0], r[1]) for r in part.groupBy("episode_index").count().collect()} == {(3, 200), (4, 200), (990, 200)}
    assert "PushedFilters: [Or(" in part._jdf.queryExecution().executedPlan().toString()
    assert scanned_rows(spark, part) < 60_000 < 200_000 == scanned_rows(spark, shards)
    assert frames.slice_episodes(shards, wanted.where("episode_index IS NULL")).count() == 0


def scanned_rows(spark, df):
    """Rows that the parquet scan of a plan gives out."""
    from py4j.java_gateway import is_instance_of

    plan = df.select(*df.columns)._jdf.queryExecution().executedPlan()
    if is_instance_of(spark.sparkContext._gateway, plan, "org.apache.spark.sql.execution.adaptive.AdaptiveSparkPlanExec"):
        plan.executeCollect()
        plan = plan.executedPlan()
    else:
        plan.executeCollect()
    scans = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            scans.append(node.metrics().apply("numOutputRows").value())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(node.plan())
        kids = node.children()
        for k in range(kids.size()):
            walk(kids.apply(k))

    walk(plan)
    return max(scans)


def test_info_files(spark, tmp_path):
    good = {"codebase_version": "v2.1", "fps": 10, "features": {"action": {"dtype": "float32"}, "top": {"dtype": "video"}}}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "b.json").write_text("[1]")
    (tmp_path / "c.json").write_text("{nope")
    info = frames.scan_info(spark, str(tmp_path))
    problems = {os.path.basename(r["path"]): r["problem"] for r in info.collect()}
    assert problems == {"a.json": None, "b.json": "not a JSON object but ARRAY<BIGINT>", "c.json": "not valid JSON"}
    features = frames.info_features(info).where("name IS NOT NULL")
    assert {(r["name"], r["dtype"]) for r in features.collect()} == {("action", "float32"), ("top", "video")}
    assert [r["name"] for r in frames.camera_keys(features).collect()] == ["top"]
    with pytest.raises(Exception, match="not valid JSON"):
        frames.scan_info(spark, str(tmp_path / "c.json"), strict=True).collect()


def test_newer_formats_fail_when_asked_to(spark):
    df = spark.createDataFrame([("v4.0",)], "v STRING")
    with pytest.raises(Exception, match="newer"):
        df.select(scalars.F.length(frames.require_format(F.col("v")))).collect()


def test_episode_lines_keep_positions_across_byte_ranges(spark, tmp_path):
    lines, want = [], []
    for i in range(3000):
        if i % 7 == 0:
            lines.append("   ")
        own = i % 3 == 0
        row = {"length": 0, "episode_length": i} if own else {"episode_index": 10_000 + i, "length": str(i)}
        lines.append(json.dumps(row))
        want.append((i if own else 10_000 + i, i))
    (tmp_path / "episodes.jsonl").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = frames.scan_episodes_jsonl(spark, str(tmp_path / "episodes.jsonl"))
        assert got.rdd.getNumPartitions() >= 1
        rows = sorted((r["pos"], r["episode_index"], r["length"]) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == [(p, e, n) for p, (e, n) in enumerate(want)]


def test_task_tables(spark, tmp_path):
    (tmp_path / "tasks.jsonl").write_text(
        '{"task_index":0,"task":"a"}\n{"task_index":"1","description":"b"}\n{"task":"x"}\n{"task_index":0,"task":"z"}\n'
    )
    got = {r["task_index"]: r["task"] for r in frames.tasks_from_lines(spark, str(tmp_path / "tasks.jsonl")).collect()}
    assert got == {0: "z", 1: "b"}
    pd.DataFrame({"__index_level_0__": ["pick", "place"]}).to_parquet(tmp_path / "tasks.parquet")
    got = {r["task_index"]: r["task"] for r in frames.tasks_from_parquet(spark, str(tmp_path / "tasks.parquet")).collect()}
    assert got == {0: "pick", 1: "place"}


def test_archives_refuse_pickles_and_scalars(spark, tmp_path):
    np.savez(
        tmp_path / "e1.npz",
        **{
            "/cmd_vel/linear": np.arange(9, dtype="float32").reshape(3, 3),
            "/cmd_vel/_t_ns": np.array([5, 6, 7]),
            "schema": np.array(1),
            "/meta/labels": np.array(["a", None], dtype=object),
        },
    )
    (tmp_path / "bad.npz").write_bytes(b"no archive")
    samples, notes = arrays.scan_npz(spark, str(tmp_path))
    linear = sorted((r["step"], r["t_ns"], r["value"]) for r in samples.where("key = '/cmd_vel/linear'").collect())
    assert linear == [(0, 5, [0, 1, 2]), (1, 6, [3, 4, 5]), (2, 7, [6, 7, 8])]
    reasons = {r["item"]: r["reason"] for r in notes.collect()}
    assert set(reasons) == {"schema", "/meta/labels", "*"}
    assert reasons["/meta/labels"].startswith("refused")


def test_id_lists_and_csv(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# pinned\n e1 \n\ne2\n")
    ids = arrays.baseline_ids(spark, str(tmp_path / "ids.txt"))
    assert sorted(r[0] for r in ids.collect()) == ["e1", "e2"]
    (tmp_path / "a.csv").write_text("t_s,cmd_vx,grip\n0.5,1.5,0\n")
    rows = arrays.scan_csv_actions(spark, str(tmp_path / "a.csv"), ["cmd_vx", "grip"]).collect()
    assert {(r["key"], r["t_ns"], r["value"][0]) for r in rows} == {
        ("cmd_vx/value", 500_000_000, 1.5), ("grip/value", 500_000_000, 0.0),
    }


def demo_tables(spark):
    ddl = "path STRING, demo STRING, name STRING, kind STRING, itemsize INT, shape ARRAY<BIGINT>, row_start BIGINT, data ARRAY<DOUBLE>"
    rows = []
    for demo, n in (("demo_10", 3), ("demo_2", 5)):
        rows += [
            ("lift", demo, "actions", "f", 8, [n, 7], 0, [0.0] * 7 * n),
            ("lift", demo, "rewards", "f", 8, [n], 0, [1.0] * n),
            ("lift", demo, "dones", "i", 8, [n], 0, [0.0] * (n - 1) + [1.0]),
            ("lift", demo, "obs/agentview_image", "u", 1, [n, 12, 16, 3], 0, None),
        ]
    rows += [
        ("aloha", None, "action", "f", 4, [4, 14], 0, [0.0] * 28),
        ("aloha", None, "action", "f", 4, [4, 14], 2, [1.0] * 28),
        ("aloha", None, "observations/qpos", "f", 4, [4, 14], 0, [0.0] * 56),
        ("aloha", None, "observations/images/top", "u", 1, [4, 12, 16, 3], 0, None),
        ("other", None, "notes", "f", 4, [4], 0, [0.0] * 4),
    ]
    env = json.dumps({"env_args": json.dumps({"env_name": "Lift", "env_kwargs": {"robots": ["Panda"], "control_freq": 20}})})
    attrs = spark.createDataFrame(
        [("lift", None, env), ("aloha", None, '{"sim":false}'), ("lift", "demo_2", '{"num_samples":5}')],
        "path STRING, demo STRING, a STRING",
    ).select("path", "demo", F.parse_json("a").alias("attrs"))
    return spark.createDataFrame(rows, ddl), attrs


def test_demonstration_files(spark):
    datasets, attrs = demo_tables(spark)
    layouts = {r["path"]: r["layout"] for r in demos.layout(datasets).collect()}
    assert layouts == {"lift": "robomimic", "aloha": "single", "other": None}
    with pytest.raises(Exception, match="unsupported"):
        demos.layout(datasets, strict=True).collect()
    got = {r["path"]: r for r in demos.file_summary(datasets, attrs).collect()}
    lift = got["lift"]
    assert (lift["fps"], lift["fps_assumed"], lift["robot_type"], lift["env_name"]) == (20.0, False, "Panda", "Lift")
    assert (lift["total_episodes"], lift["total_steps"], lift["cameras"]) == (2, 8, "obs/agentview_image")
    assert (got["aloha"]["fps"], got["aloha"]["fps_assumed"], got["aloha"]["robot_type"]) == (30.0, True, "real")
    refs = demos.episode_refs(demos.trajectory_lengths(datasets, attrs)).where("path = 'lift'").orderBy("index")
    assert [r["demo"] for r in refs.collect()] == ["demo_2", "demo_10"]
    fixed = demos.file_summary(datasets, attrs, user_fps=50.0).where("path = 'aloha'").first()
    assert (fixed["fps"], fixed["fps_assumed"]) == (50.0, False)


def test_demonstration_series_and_outcomes(spark):
    from runlens.operators import outcomes, pack

    datasets, _ = demo_tables(spark)
    out = {r["demo"]: r for r in outcomes.demo_outcomes(datasets).collect()}
    assert out["demo_2"]["outcome"] == {"rewards": 1.0, "dones": 1.0} and out["demo_2"]["reward_sum"] == 5.0
    rows = pack.pack_demos(datasets, F.lit(20.0)).where("path = 'aloha' AND key = 'action/value'").orderBy("step").collect()
    assert [(r["step"], r["t_ns"], len(r["value"]), r["value"][0]) for r in rows] == [
        (0, 0, 14, 0.0), (1, 50_000_000, 14, 0.0), (2, 100_000_000, 14, 1.0), (3, 150_000_000, 14, 1.0),
    ]


def test_outcome_sources_and_types(spark):
    cases = [
        ('{"lerobot_episode_outcome":{"next.success":true,"next.reward_sum":12.4}}', (True, 12.4, None, None)),
        ('{"outcome":{"success":false,"reward_total":3.2},"lerobot_episode_outcome":{"next.success":true}}', (False, 3.2, None, None)),
        ('{"success":"true","reward":true,"collision_count":2}', (None, 1.0, 2.0, None)),
        ('{"success":1,"time_to_goal_s":null,"outcome":{"time_to_goal_s":4}}', (None, None, None, 4.0)),
        ('{"outcome":[1]}', (None, None, None, None)),
        ('{"hdf5_episode_outcome":{"reward_sum":5.0}}', (None, None, None, None)),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i INT, m STRING")
    rows = df.select("i", outcome.extract_outcome(F.parse_json("m")).alias("o")).collect()
    assert {r["i"]: tuple(r["o"]) for r in rows} == {i: c[1] for i, c in enumerate(cases)}
    wide = df.where("i = 5").select(outcome.extract_outcome(F.parse_json("m"), extended=True).alias("o")).first()
    assert wide["o"]["reward_total"] == 5.0


def test_typed_encoding_round_trip(spark):
    row = spark.range(1).select(typed.encode("EpisodeOutcome", success=F.lit(True), reward_total=F.lit(1.5)).alias("t")).first()
    assert json.loads(row["t"]) == {
        "__type": "runlens.EpisodeOutcome", "success": True, "reward_total": 1.5, "collision_count": None, "time_to_goal_s": None,
    }
    with pytest.raises(ValueError):
        typed.encode("Battery", volts=F.lit(1))


def test_seconds_are_truncated_like_float32(spark):
    row = spark.sql("SELECT CAST(0.1 AS FLOAT) AS t").select(scalars.seconds_to_ns(F.col("t"))).first()
    assert row[0] == int(np.float64(np.float32(0.1)) * 1e9) == 100000001


def test_a_whole_dataset_from_files_to_samples(spark, tmp_path):
    """Two episodes of 5 and 3 frames, one file each, with lines of metadata."""
    from runlens.operators import outcomes, pack

    features = {
        "observation.state": {"dtype": "float32"},
        "observation.images.top": {"dtype": "video"},
        "action": {"dtype": "float32"},
        "next.reward": {"dtype": "float32"},
        "timestamp": {"dtype": "float32"},
    }
    meta = tmp_path / "meta"
    meta.mkdir()
    info = {"codebase_version": "v2.1", "fps": 10, "total_episodes": 2, "total_frames": 0, "features": features}
    (meta / "info.json").write_text(json.dumps(info))
    (meta / "episodes.jsonl").write_text(
        '{"episode_index":0,"tasks":["pick"],"length":5}\n{"length":3,"task_index":1}\n'
    )
    (meta / "tasks.jsonl").write_text('{"task_index":0,"task":"pick"}\n{"task_index":1,"task":"place"}\n')
    for ep, n in ((0, 5), (1, 3)):
        path = tmp_path / f"data/chunk-000/episode_{ep:06d}.parquet"
        os.makedirs(path.parent, exist_ok=True)
        pd.DataFrame(
            {
                "timestamp": np.arange(n, dtype="float32") / np.float32(10),
                "frame_index": range(n),
                "observation.state": [np.full(6, i, "float32") for i in range(n)],
                "action": [np.full(3, i, "float32") for i in range(n)],
                "next.reward": np.full(n, 0.5, "float32"),
                "next.done": [i == n - 1 for i in range(n)],
            }
        ).to_parquet(path)

    declared = frames.info_features(frames.scan_info(spark, str(meta / "info.json")), strict=True)
    episodes = frames.scan_episodes_jsonl(spark, str(meta / "episodes.jsonl"))
    tasks = frames.tasks_from_lines(spark, str(meta / "tasks.jsonl"))
    named = frames.with_tasks(frames.task_fields(episodes), tasks)
    assert {(r["episode_index"], r["length"], tuple(r["task_list"])) for r in named.collect()} == {
        (0, 5, ("pick",)), (1, 3, ("place",)),
    }
    one = declared.select("total_episodes", "total_frames").distinct().withColumn("path", F.lit("d"))
    total = frames.dataset_summary(one, episodes.withColumn("path", F.lit("d"))).first()
    assert (total["total_episodes"], total["total_frames"]) == (2, 8)

    data = frames.scan_frames_v2(spark, str(tmp_path))
    samples, notes = pack.pack_frames(data, ["observation.state", "observation.gone", "action"])
    counts = {(r["episode_id"], r["key"], r["slot"]): r["count"] for r in samples.groupBy("episode_id", "key", "slot").count().collect()}
    assert counts == {
        (0, "observation.state/value", "sensors"): 5, (1, "observation.state/value", "sensors"): 3,
        (0, "action/value", "actions"): 5, (1, "action/value", "actions"): 3,
    }
    assert samples.where("step = 1").first()["t_ns"] == 100000001
    assert [r["item"] for r in notes.collect()] == ["observation.gone"]
    ends = outcomes.frame_outcomes(data, ["next.reward", "next.done"], "episode_index", "frame_index")
    got = {r["episode_index"]: (r["outcome"]["next.done"], r["reward_sum"]) for r in ends.collect()}
    assert got == {0: (True, 2.5), 1: (True, 1.5)}


def test_broken_lines_are_no_episodes_and_all_blanks_are_stripped(spark, tmp_path):
    path = tmp_path / "episodes.jsonl"
    path.write_text('{"episode_index": 4, "length": 3}\n\t \n{broken\n\t{"length": 5}\u00a0\n')
    rows = frames.scan_episodes_jsonl(spark, str(path)).collect()
    assert sorted((r["pos"], r["episode_index"], r["length"]) for r in rows) == [(0, 4, 3), (2, 2, 5)]
    assert [(r["pos"], r["line"]) for r in frames.broken_lines(spark, str(path)).collect()] == [(1, "{broken")]
    with pytest.raises(Exception, match="no JSON in line 1"):
        frames.scan_episodes_jsonl(spark, str(path), strict=True).collect()


def test_roots_with_blanks(spark, tmp_path):
    root = tmp_path / "my data"
    for chunk in (0, 1):
        spark.range(2).coalesce(1).write.parquet(str(root / f"tmp{chunk}"))
        target = root / "data" / f"chunk-00{chunk}"
        target.mkdir(parents=True)
        part = next((root / f"tmp{chunk}").glob("part-*.parquet"))
        (target / "episode_000003.parquet").write_bytes(part.read_bytes())
    assert frames.scan_frames_v2(spark, str(root)).count() == 2


def test_written_descriptions_are_dealt_over_tasks_and_read_once(spark, monkeypatch):
    """One task made all files, and the scan of them ran on both sides of a join."""
    from runlens.plans import datasets, staging

    roots, reads = [], []
    old_fresh, old_scan = staging.fresh, frames.scan_info
    monkeypatch.setattr(staging, "fresh", lambda *a: roots.append(old_fresh(*a)) or roots[-1])
    monkeypatch.setattr(frames, "scan_info", lambda *a, **k: reads.append(old_scan(*a, **k)) or reads[-1])
    out = datasets.scan_info(spark, "/root/testdata/sf0.01")
    written = [p.name for p in pathlib.Path(roots[0].removeprefix("file://")).glob("part-*")]
    assert len(written) == 100 and len({name.split("-")[1] for name in written}) > 1
    assert "FileScan text" not in out._jdf.queryExecution().executedPlan().toString()


def test_shards_of_the_slice_query_have_few_row_groups(spark, monkeypatch):
    import pyarrow.parquet as pq

    from runlens.plans import datasets, staging

    roots, old_fresh = [], staging.fresh
    monkeypatch.setattr(staging, "fresh", lambda *a: roots.append(old_fresh(*a)) or roots[-1])
    datasets.slice_episode(spark, "/root/testdata/sf0.01")
    files = pathlib.Path(roots[0].removeprefix("file://")).glob("data/chunk-000/*.parquet")
    metas = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_rows for m in metas) == 60_000 and all(m.num_row_groups <= 1 for m in metas)


def test_archives_are_opened_once_for_samples_and_issues(spark, tmp_path):
    np.savez(tmp_path / "a.npz", x=np.arange(3.0), s=np.array(1))
    samples, issues = arrays.scan_npz(spark, str(tmp_path))
    for part in (samples, issues):
        assert "MapInPandas" not in part._jdf.queryExecution().executedPlan().toString()
    assert (samples.count(), issues.count()) == (3, 1)
