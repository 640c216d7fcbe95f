from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from runlens.functions import flatten as fl
from runlens.operators import alignment, outcomes, pack, quality, sink
from runlens.sources import recordings as rec

IMAGE, JOINT, TWIST = "sensor_msgs/msg/Image", "sensor_msgs/msg/JointState", "geometry_msgs/msg/Twist"
V3 = {"x": 1.0, "y": 2.0, "z": 3.0}


def messages(spark, rows):
    df = spark.createDataFrame(
        [(r, t, m, ns, i, json.dumps(p)) for i, (r, t, m, ns, p) in enumerate(rows)],
        "recording_id BIGINT, topic STRING, msgtype STRING, t_ns BIGINT, seq BIGINT, p STRING",
    )
    return df.withColumn("payload", F.parse_json("p")).drop("p")


@pytest.fixture(scope="module")
def bag(spark):
    ms = 1_000_000
    rows = [(1, "/camera/image_raw", IMAGE, i * 100 * ms, {"height": 24, "width": 32}) for i in range(5)]
    rows += [(1, "/joint_states", JOINT, i * 200 * ms, {"position": [float(i)] * 6}) for i in range(5)]
    rows += [(1, "/cmd_vel", TWIST, i * 300 * ms, {"linear": V3, "angular": V3}) for i in range(3)]
    return messages(spark, rows)


def test_summary_counts_span_and_slots(spark, bag):
    ids = spark.createDataFrame([(1,), (2,)], "recording_id BIGINT")
    rows = rec.bag_summary(bag, ids).collect()
    full = {r["topic"]: r for r in rows if r["recording_id"] == 1}
    assert full["/cmd_vel"]["message_count"] == 13 and full["/cmd_vel"]["duration_s"] == pytest.approx(0.8)
    assert {t: r["slot"] for t, r in full.items()} == {
        "/camera/image_raw": "video", "/joint_states": "sensors", "/cmd_vel": "actions",
    }
    empty = [r for r in rows if r["recording_id"] == 2]
    assert [(r["topic"], r["message_count"], r["duration_s"]) for r in empty] == [(None, 0, None)]


def test_frame_rate_of_the_camera(bag):
    rates = {r["topic"]: (r["fps"], r["is_primary"]) for r in alignment.infer_fps(bag).collect()}
    # Image and joint topics both have five messages; the image came first.
    assert rates["/camera/image_raw"] == (10.0, True)
    assert rates["/joint_states"] == (5.0, False)


def test_single_message_uses_the_fallback_rate(spark):
    one = messages(spark, [(1, "/c", IMAGE, 5, {})])
    assert alignment.infer_fps(one).first()["fps"] == 10.0


def test_packed_shapes(bag):
    samples = pack.pack_messages(pack.flat_messages(bag)).collect()
    got = {}
    for r in samples:
        got.setdefault(r["key"], []).append(len(r["value"]))
    assert got["/joint_states/position"] == [6] * 5
    assert got["/cmd_vel/linear"] == [3] * 3 and got["/cmd_vel/angular"] == [3] * 3


def issues(spark, payloads, msgtype=JOINT):
    rows = [(1, "/t", msgtype, i, p) for i, p in enumerate(payloads)]
    return {r["reason"] for r in pack.message_issues(pack.flat_messages(messages(spark, rows))).collect()}


def test_the_earlier_problem_of_a_field_is_reported(spark):
    one, two, none = {"position": [1.0]}, {"position": [1.0, 2.0]}, {"velocity": [1.0]}
    gone = "field_absent field=position"
    changed = "field_shape field=position found=(2,) expected=(1,)"
    late = "field_absent field=velocity"
    assert issues(spark, [one, two, none]) == {changed, late}
    assert issues(spark, [one, none, two]) == {gone, late}
    assert issues(spark, [none, one, one]) == {gone, late}
    assert issues(spark, [one, one]) == set()


def test_a_flatten_error_drops_the_topic(spark):
    got = issues(spark, [{"linear": V3, "angular": V3}, {"linear": V3}], TWIST)
    assert got == {f"unreadable msgtype={TWIST} cause=angular.x missing"}


def test_topic_without_numbers(spark):
    assert issues(spark, [{"name": "x"}], "std_msgs/msg/String") == {"no_numbers"}


def test_messages_are_walked_as_deep_as_they_are(spark):
    deep = 1
    for k in range(12):
        deep = {f"k{k}": deep, "x": k}
    rows = messages(spark, [(1, "/t", "x/msg/Deep", 0, deep)])
    stored = pack.stored_flat_messages(rows)
    assert stored.first()["failed"] is None and len(stored.first()["fields"]) == 13
    assert pack.flat_messages(rows, depth=6).first()["failed"] is not None


def test_custom_flatteners_replace_the_generic_walk(spark):
    def gripper(msg):
        entry = F.struct(
            F.lit("grip").alias("field"),
            F.array(F.try_variant_get(msg, "$.w", "double")).cast("array<float>").alias("value"),
            F.lit(True).alias("scalar"),
        )
        return F.struct(F.array(entry).alias("fields"), F.lit(None).cast("string").alias("failed"))

    df = messages(spark, [(1, "/g", "x/msg/Grip", 0, {"w": 4, "other": 1})])
    row = pack.flat_messages(df, {"x/msg/Grip": gripper}).first()
    assert [(f["field"], f["value"]) for f in row["fields"]] == [("grip", [4.0])]


def test_generic_walk(spark):
    payload = {"a": 1, "b": {"c": True, "_d": 3, "e": "x", "f": None}, "l": [1, 2.5], "o": [{"x": 1}], "s": ["a"]}
    df = messages(spark, [(1, "/g", "x/msg/Any", 0, payload)])
    fields = df.select(fl.generic(F.col("payload"))["fields"].alias("f")).first()["f"]
    assert {f["field"]: (f["value"], f["scalar"]) for f in fields} == {
        "a": ([1.0], True), "b.c": ([1.0], True), "l": ([1.0, 2.5], False),
    }
    bare = spark.sql("SELECT parse_json('7') AS v").select(fl.generic(F.col("v"))["fields"].alias("f")).first()["f"]
    assert [(f["field"], f["value"]) for f in bare] == [("value", [7.0])]


def test_cameras_align_by_index(spark):
    rows = [(1, "/b", i * 10, i, 48, 30) for i in range(3)] + [(1, "/a", i * 7, 10 + i, 32, 24) for i in range(2)]
    df = spark.createDataFrame(rows, "recording_id BIGINT, topic STRING, t_ns BIGINT, seq BIGINT, width INT, height INT")
    got = sorted(alignment.camera_frames(df).collect(), key=lambda r: r["frame"])
    assert [(r["frame"], r["total_width"], r["max_height"]) for r in got] == [(0, 80, 30), (1, 80, 30)]
    assert [c["topic"] for c in got[0]["cells"]] == ["/a", "/b"]
    assert alignment.require_camera(df, "/a").count() == 2
    with pytest.raises(Exception, match="no camera /z"):
        alignment.require_camera(df, "/z").collect()


def test_ragged_columns(spark):
    rows = [("ok", 0, [1.0]), ("ok", 1, [2.0]), ("len", 0, [1.0]), ("len", 1, [1.0, 2.0]), ("len", 2, None),
            ("null", 0, [1.0]), ("null", 1, None), ("first", 0, None), ("first", 1, [1.0])]
    df = spark.createDataFrame(rows, "g STRING, pos INT, v ARRAY<DOUBLE>")
    got = {r["g"]: r["reason"] for r in quality.ragged_columns(df, ["g"], "v", "pos").collect()}
    assert got == {
        "ok": None,
        "len": "row_length row=1 found=2 expected=1",
        "null": "row_length row=1 found=0 expected=1",
        "first": "row_length row=0 found=0 expected=0",
    }


def test_rollouts_stop_at_the_first_terminal_step(spark):
    rows = [("a", i, 1.0, i in (7, 9), False) for i in range(12)] + [("b", i, 0.5, False, False) for i in range(12)]
    df = spark.createDataFrame(rows, "episode_id STRING, step BIGINT, reward DOUBLE, terminated BOOLEAN, truncated BOOLEAN")
    long = spark.range(12_000).selectExpr("'c' AS episode_id", "id AS step", "1.0D AS reward", "false AS terminated", "false AS truncated")
    assert outcomes.rollout_totals(long).first()["steps"] == 12_000
    got = {r["episode_id"]: r for r in outcomes.rollout_totals(df, max_steps=10).collect()}
    assert (got["a"]["steps"], got["a"]["total_reward"], got["a"]["terminated"]) == (8, 8.0, True)
    assert (got["b"]["steps"], got["b"]["terminated"], got["b"]["duration_s"]) == (10, False, pytest.approx(1 / 3))


def test_two_dimensional_frames_without_clock_are_skipped(spark):
    df = spark.createDataFrame([(0, 0, [1.0])], "episode_index BIGINT, frame_index BIGINT, action ARRAY<DOUBLE>")
    samples, notes = pack.pack_frames(df, ["action"])
    assert samples.count() == 0
    assert notes.first()["reason"] == "no_clock"


def test_samples_are_written_by_slot(spark, bag, tmp_path):
    samples = pack.pack_messages(pack.flat_messages(bag))
    sink.write_samples(samples, str(tmp_path / "samples"), "bag")
    back = sink.committed(spark, str(tmp_path / "samples"), samples.schema)
    assert back.count() == samples.count()
    assert {p.name for p in (tmp_path / "samples").glob("files/*/slot=*")} == {"slot=video", "slot=sensors", "slot=actions"}


def test_reports_round_by_the_exact_value(spark):
    """As printf does: ties to the even digit, and 1.005 lies below its text."""
    from runlens.functions.scalars import fixed_text, number_text

    values = [0.125, 0.375, 1.005, 2.675, 2515.625, 0.0, 12345.0, 1e-9, 0.995, -0.125, 1e15 / 8]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    got = [r[1] for r in df.select("i", fixed_text(F.col("v"), 2)).orderBy("i").collect()]
    assert got == [f"{v:.2f}" for v in values]
    signed = [r[1] for r in df.select("i", number_text(F.col("v") / 100, signed=True)).orderBy("i").collect()]
    assert signed == [f"{v / 100:+.3f}" for v in values]
    summary = spark.createDataFrame(
        [(7, 1, 0.125, None, None, None, None, None)],
        "recording_id BIGINT, message_count BIGINT, duration_s DOUBLE, topic STRING, msgtype STRING, n BIGINT, slot STRING, reason STRING",
    )
    assert [r["line"] for r in rec.bag_report(summary).collect()] == ["7  0.12s, 1 message"]
