"""Scalar rules, applied to every event row, and rules over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions import classify, scalars, typed
from runlens.functions.outcome import merge_metadata
from runlens.plans import bindings as B
from runlens.plans.registry import query
from runlens.sources import demos

def _count() -> Column:
    return F.count(F.lit(1)).alias("n")



def _literal(v: Any, spark: bool) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    if isinstance(v, list):
        inner = ",".join(_literal(x, spark) for x in v)
        return f"array({inner})" if spark else f"[{inner}]"
    return "'" + v.replace("'", "''") + "'"


def _rows(rows: Sequence[Sequence[Any]], spark: bool) -> str:
    return ",".join(f"({i},{','.join(_literal(v, spark) for v in r)})" for i, r in enumerate(rows))


def rule(
    name: str,
    inputs: str,
    outputs: str,
    cases: Sequence[tuple[Sequence[Any], Sequence[Any]]],
    apply: Callable[[], dict[str, Column]],
) -> None:
    """Register a scalar rule over literal cases spread over all events.

    Each case is (input values, expected output values); event ``e`` gets case
    ``e % n``. The SQL twin knows only the expected outputs.
    """
    n = len(cases)
    given = _rows([c[0] for c in cases], spark=True)
    wanted = _rows([c[1] for c in cases], spark=False)
    oracle = f"""SELECT w.case_no, {", ".join("w." + c.strip() for c in outputs.split(","))}, count(*) AS n
      FROM events e JOIN (VALUES {wanted}) AS w(case_no, {outputs}) ON e.event_id % {n} = w.case_no GROUP BY ALL"""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ev = B.cases(spark, sf_dir, given, inputs, n)
        made = apply()
        out = ev.select((F.col("event_id") % n).alias("case_no"), *[v.alias(k) for k, v in made.items()])
        return out.groupBy("case_no", *made).agg(_count())

    query(name, oracle)(run)


def _fields(verdict: Column, *names: str) -> dict[str, Column]:
    return {n: verdict[n] for n in names}


rule(
    "classify_column",
    "name",
    "slot, reason",
    [
        (["timestamp"], ["internal", "exact"]),
        (["task_index"], ["internal", "exact"]),
        (["index"], ["internal", "exact"]),
        (["observation.images.laptop"], ["video", "prefix"]),
        (["observation.image"], ["sensors", "prefix"]),
        (["action"], ["actions", "prefix"]),
        (["action.gripper"], ["actions", "prefix"]),
        (["actions"], ["sensors", "default"]),
        (["Action"], ["sensors", "default"]),
        (["next.reward"], ["episode_meta", "prefix"]),
        (["observation.state"], ["sensors", "prefix"]),
        (["timestamp.extra"], ["sensors", "default"]),
    ],
    lambda: _fields(classify.classify_column(F.col("name")), "slot", "reason"),
)

rule(
    "classify_dataset",
    "name",
    "slot, reason",
    [
        (["timestamps"], ["internal", "exact"]),
        (["obs/Timestamp"], ["internal", "exact"]),
        (["actions"], ["actions", "leaf"]),
        (["obs/action_prev"], ["actions", "leaf"]),
        (["action_dict/abs_pos"], ["actions", "leaf"]),
        (["action/gripper"], ["actions", "leaf"]),
        (["actionable/x"], ["sensors", "default"]),
        (["rewards"], ["episode_meta", "exact"]),
        (["data/DONES"], ["episode_meta", "exact"]),
        (["observations/images/top"], ["video", "segment"]),
        (["obs/agentview_image"], ["video", "leaf"]),
        (["obs/wrist_rgb"], ["video", "leaf"]),
        (["obs/depth_front"], ["video", "leaf"]),
        (["//obs//robot0_eef_pos"], ["sensors", "default"]),
        (["states"], ["sensors", "default"]),
        (["action_dict/index"], ["internal", "exact"]),
        (["/"], ["sensors", "default"]),
    ],
    lambda: _fields(classify.classify_dataset(F.col("name")), "slot", "reason"),
)

rule(
    "camera_predicate",
    "name, shape, kind, itemsize",
    "camera, slot",
    [
        (["obs/a_image", [5, 12, 16, 3], "u", 1], [True, "video"]),
        (["obs/a_image", [5, 12, 16, 3], "i", 1], [True, "video"]),
        (["obs/a_image", [5, 12, 16, 3], "f", 4], [False, "sensors"]),
        (["obs/a_image", [5, 12, 16, 2], "u", 1], [False, "sensors"]),
        (["obs/a_image", [5, 12, 16], "u", 1], [False, "sensors"]),
        (["obs/depth", [5, 12, 16, 1], "u", 2], [True, "video"]),
        (["states", [5, 12, 16, 4], "u", 1], [True, "sensors"]),
    ],
    lambda: {
        "camera": classify.is_camera(F.col("shape"), F.col("kind"), F.col("itemsize")),
        "slot": classify.demo_slot(F.col("name"), F.col("shape"), F.col("kind"), F.col("itemsize")),
    },
)

rule(
    "key_split",
    "key",
    "ns, field",
    [
        (["/cmd_vel/linear"], ["/cmd_vel", "linear"]),
        (["action"], ["", "action"]),
        (["a/b/c"], ["a/b", "c"]),
        (["/x"], ["", "x"]),
        (["x/"], ["x", ""]),
    ],
    lambda: {"ns": classify.key_namespace(F.col("key")), "field": classify.key_field(F.col("key"))},
)

rule(
    "kind_from_ext",
    "path",
    "kind",
    [
        (["/runs/a.mp4"], ["video"]),
        (["/runs/a.MOV"], ["video"]),
        (["a.b.npz"], ["sensors"]),
        (["x.hdf5"], ["sensors"]),
        (["x.parquet"], ["actions"]),
        (["x.arrow"], ["actions"]),
        (["x.csv"], [None]),
        (["/runs.mp4/file"], [None]),
        ([".mp4"], [None]),
        (["noext"], [None]),
    ],
    lambda: {"kind": classify.kind_from_extension(F.col("path"))},
)

rule(
    "version_gate",
    "version",
    "status",
    [
        (["v2.0"], ["ok"]),
        (["v2.1"], ["ok"]),
        (["v3.0"], ["ok"]),
        (["v3.9"], ["ok"]),
        (["v4.0"], ["newer"]),
        (["v9"], ["newer"]),
        (["v1.6"], ["unknown"]),
        (["v2.2"], ["unknown"]),
        (["3.0"], ["unknown"]),
        ([None], ["unknown"]),
    ],
    lambda: {"status": classify.format_support(F.col("version"))},
)

rule(
    "resolve_fps",
    "user_fps, file_fps",
    "fps, assumed",
    [
        ([50.0, 20.0], [50.0, False]),
        ([None, 20.0], [20.0, False]),
        ([0.0, 20.0], [20.0, False]),
        ([-1.0, None], [30.0, True]),
        ([None, 0.0], [30.0, True]),
        ([None, None], [30.0, True]),
    ],
    lambda: _fields(scalars.resolve_fps(F.col("user_fps"), F.col("file_fps")), "fps", "assumed"),
)

rule(
    "clip_window",
    "from_s, to_s, fps",
    "first, past",
    [
        ([0.0, 1.0, 30.0], [0, 30]),
        ([0.5, 1.5, 1.0], [0, 2]),
        ([1.5, 2.5, 1.0], [2, 3]),
        ([-1.0, 0.2, 10.0], [0, 2]),
        ([3.0, 3.0, 10.0], [30, 31]),
        ([2.0, 1.0, 10.0], [20, 21]),
    ],
    lambda: {
        "first": scalars.clip_window(F.col("from_s"), F.col("to_s"), F.col("fps"))["start"],
        "past": scalars.clip_window(F.col("from_s"), F.col("to_s"), F.col("fps"))["end"],
    },
)

rule(
    "env_meta",
    "raw",
    "env_name, robot_type, fps",
    [
        (['{"env_name":"Lift","env_kwargs":{"robots":["Panda"],"control_freq":20}}'], ["Lift", "Panda", 20.0]),
        (['{"env_name":"Can","env_kwargs":{"robots":"Sawyer","control_freq":0}}'], ["Can", "Sawyer", None]),
        (['{"env_name":"Door","env_kwargs":{"robots":[]}}'], ["Door", None, None]),
        (["not json"], [None, None, None]),
        ([None], [None, None, None]),
        (['{"env_kwargs":{"control_freq":"20"}}'], [None, None, None]),
    ],
    lambda: _fields(demos.env_meta(F.col("raw")), "env_name", "robot_type", "fps"),
)

rule(
    "validate_joint_state",
    "np, nv, ne, nn",
    "violations",
    [
        ([3, 3, 3, 3], [""]),
        ([3, None, None, None], [""]),
        ([0, 2, None, None], ["empty field=positions"]),
        ([3, 2, None, None], ["unequal field=velocities found=2 expected=3"]),
        ([2, None, 3, 1], ["unequal field=efforts found=3 expected=2|unequal field=names found=1 expected=2"]),
    ],
    lambda: {
        "violations": F.array_join(
            typed.joint_state_violations(*[F.array_repeat(F.col("value"), F.col(c)) if c == "np" else F.when(F.col(c).isNotNull(), F.array_repeat(F.col("value"), F.col(c))) for c in ("np", "nv", "ne")],
                                         F.when(F.col("nn").isNotNull(), F.array_repeat(F.lit("j"), F.col("nn")))),
            "|",
        )
    },
)


def _repeat(col: str) -> Column:
    return F.when(F.col(col).isNotNull(), F.array_repeat(F.col("value"), F.col(col)))


rule(
    "validate_typed",
    "n3, n4, m3",
    "pose, twist, imu",
    [
        ([3, 4, 3], ["", "", ""]),
        ([2, 4, 3], ["width field=translation found=2 expected=3", "width field=linear found=2 expected=3", "width field=linear_acceleration found=2 expected=3"]),
        ([3, None, 3], ["absent field=rotation", "", ""]),
        ([3, 3, 4], ["width field=rotation found=3 expected=4", "width field=angular found=4 expected=3", "width field=angular_velocity found=4 expected=3|width field=orientation found=3 expected=4"]),
    ],
    lambda: {
        "pose": F.array_join(typed.pose_violations(_repeat("n3"), _repeat("n4")), "|"),
        "twist": F.array_join(typed.twist_violations(_repeat("n3"), _repeat("m3")), "|"),
        "imu": F.array_join(typed.imu_violations(_repeat("n3"), _repeat("m3"), _repeat("n4")), "|"),
    },
)

rule(
    "metadata_merge",
    "ka, va, kb, vb",
    "merged",
    [
        (["adapter", "made", "adapter", "mine"], ["adapter=mine"]),
        (["adapter", "made", "note", "mine"], ["adapter=made,note=mine"]),
        (["adapter", "made", "adapter", None], ["adapter=null"]),
        (["adapter", "made", None, None], ["adapter=made"]),
    ],
    lambda: {
        "merged": F.array_join(
            F.sort_array(
                F.transform(
                    F.map_entries(
                        merge_metadata(
                            F.create_map("ka", "va"), F.when(F.col("kb").isNotNull(), F.create_map("kb", "vb"))
                        )
                    ),
                    lambda e: F.concat_ws("=", e["key"], F.coalesce(e["value"], F.lit("null"))),
                )
            ),
            ",",
        )
    },
)

rule(
    "demo_sort",
    "key",
    "num, name",
    [
        (["demo_2"], [2, "demo_2"]),
        (["demo_10"], [10, "demo_10"]),
        (["demo"], [0, "demo"]),
        (["demo_x"], [0, "demo_x"]),
        (["a_b_007"], [7, "a_b_007"]),
        (["demo_1a"], [0, "demo_1a"]),
    ],
    lambda: {"num": scalars.demo_order(F.col("key"))["n"], "name": scalars.demo_order(F.col("key"))["key"]},
)


# ── rules over whole tables ──────────────────────────────────────────


@query(
    "shard_paths",
    """SELECT o_orderkey AS episode_id,
      printf('data/chunk-%03d/episode_%06d.parquet', o_orderkey // 1000, o_orderkey) AS frame_file,
      printf('data/chunk-%03d/episode_%06d.parquet', o_orderkey // 100, o_orderkey) AS frame_file_100,
      printf('videos/%s/chunk-%03d/episode_%06d.mp4', 'observation.images.top', o_orderkey // 1000, o_orderkey) AS video_file,
      printf('data/chunk-%03d/file-%03d.parquet', o_custkey // 1000, o_custkey) AS shard_file FROM orders""",
)
def shard_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    return B.table(spark, sf_dir, "orders").select(
        i.alias("episode_id"),
        scalars.frame_file(i).alias("frame_file"),
        scalars.frame_file(i, 100).alias("frame_file_100"),
        scalars.video_file(i, F.lit("observation.images.top")).alias("video_file"),
        scalars.shard_file(F.expr("o_custkey div 1000"), F.col("o_custkey")).alias("shard_file"),
    )


@query(
    "ts_to_ns",
    """SELECT event_id, trunc(((event_id / 10.0::DOUBLE)::FLOAT)::DOUBLE * 1e9::DOUBLE)::BIGINT AS t_ns FROM events""",
)
def ts_to_ns(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = (F.col("event_id") / 10).cast("float")
    return B.table(spark, sf_dir, "events").select("event_id", scalars.seconds_to_ns(seconds).alias("t_ns"))


@query(
    "synth_clock",
    f"""WITH {B.line_sql()}
    SELECT episode_id, step, CASE WHEN l_linenumber = 1 THEN 0 ELSE step * trunc(1e9::DOUBLE / (l_linenumber - 1))::BIGINT END AS t_ns FROM steps""",
)
def synth_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = F.col("l_linenumber") - 1
    return B.line_steps(spark, sf_dir).select(
        "episode_id", "step", scalars.synthetic_ns(F.col("step"), fps).alias("t_ns")
    )


@query(
    "episode_duration",
    """SELECT l_orderkey AS episode_id, count(*) / 10.0::DOUBLE AS at_10,
              CASE WHEN min(l_linenumber) > 1 THEN round(count(*) / (min(l_linenumber) - 1), 6) END AS at_own FROM lineitem GROUP BY 1""",
)
def episode_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = B.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode_id")).agg(
        F.count(F.lit(1)).alias("length"), (F.min("l_linenumber") - 1).alias("fps")
    )
    return per.select(
        "episode_id",
        scalars.duration_s(F.col("length"), F.lit(10.0)).alias("at_10"),
        F.round(scalars.duration_s(F.col("length"), F.col("fps"), empty_is_null=True), 6).alias("at_own"),
    )


@query(
    "vec_checks",
    """WITH v AS (SELECT vec_id, vec_id % 6 AS w FROM embeddings)
    SELECT vec_id, CASE WHEN w = 3 THEN NULL ELSE 'width field=v found=' || w || ' expected=3' END AS vec3,
           CASE WHEN w = 4 THEN NULL ELSE 'width field=q found=' || w || ' expected=4' END AS quat FROM v""",
)
def vec_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.slice("embedding", F.lit(1), (F.col("vec_id") % 6).cast("int"))
    return B.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        typed.vector_problem("v", typed.to_floats(part), 3).alias("vec3"),
        typed.vector_problem("q", typed.to_floats(part), 4).alias("quat"),
    )


@query(
    "validate_battery",
    """SELECT event_type, CASE WHEN value - 5 < 0 OR value - 5 > 100 THEN 'range field=percent low=0 high=100' ELSE '' END AS violations,
              count(*) AS n FROM events GROUP BY ALL""",
)
def validate_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.array_join(typed.battery_violations(F.col("value") - 5), "|")
    return B.table(spark, sf_dir, "events").groupBy("event_type", found.alias("violations")).agg(_count())


@query(
    "validate_outcome",
    """SELECT doc_id, concat_ws('|', CASE WHEN toxic - (doc_id % 7 = 0)::INT < 0 THEN 'range field=collision_count low=0' END,
              CASE WHEN doc_id - 5 < 0 THEN 'range field=time_to_goal_s low=0' END) AS violations FROM labels""",
)
def validate_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    collisions = F.col("toxic") - (F.col("doc_id") % 7 == 0).cast("int")
    found = typed.outcome_violations(collisions, (F.col("doc_id") - 5).cast("double"))
    return B.table(spark, sf_dir, "labels").select("doc_id", F.array_join(found, "|").alias("violations"))


@query(
    "typed_encode",
    """SELECT event_id, '{"__type":"runlens.Battery","percent":' || value || ',"voltage_v":null,"current_a":null,"charging":'
       || CASE WHEN value > 50 THEN 'true' ELSE 'false' END || '}' AS battery,
       '{"__type":"runlens.Twist","linear":[' || value || ',0.0,0.0],"angular":[0.0,0.0,0.0]}' AS twist,
       'runlens.Battery' AS tag,
       '{"robot":"r' || user_id || '","packs":{' || '"' || event_id % 3 || '":[{"at":' || event_id || ',"cell":'
       || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '{"__type":"runlens.Battery","percent":' || value || ',"voltage_v":null,"current_a":null,"charging":false}' END
       || '}]},"goal":{"__type":"runlens.EpisodeOutcome","success":' || CASE WHEN value > 50 THEN 'true' ELSE 'false' END
       || ',"reward_total":' || value || ',"collision_count":null,"time_to_goal_s":null},"said":{"k":' || event_id || '}}' AS nested
       FROM events""",
)
def typed_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0.0)
    out = B.table(spark, sf_dir, "events").select(
        "event_id",
        typed.encode("Battery", percent=F.col("value"), charging=F.col("value") > 50).alias("battery"),
        typed.encode("Twist", linear=F.array("value", zero, zero), angular=F.array(zero, zero, zero)).alias("twist"),
    )
    return out.withColumn("tag", typed.payload_type(F.parse_json("battery"))).join(_nested_payloads(spark, sf_dir), "event_id")


def _nested_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct with a map of lists of structs that hold typed payloads, a typed payload of its own and a variant."""
    none, k = F.lit(None).cast("double"), F.col("event_id")
    cell = F.struct(F.col("value").alias("percent"), none.alias("voltage_v"), none.alias("current_a"), F.lit(False).alias("charging"))
    part = F.struct(k.alias("at"), F.when(k % 5 != 0, cell).alias("cell"))
    goal = F.struct(
        (F.col("value") > 50).alias("success"), F.col("value").alias("reward_total"),
        F.lit(None).cast("bigint").alias("collision_count"), none.alias("time_to_goal_s"),
    )
    run = F.struct(
        F.concat(F.lit("r"), F.col("user_id").cast("string")).alias("robot"), F.create_map(k % 3, F.array(part)).alias("packs"),
        goal.alias("goal"), F.parse_json(F.concat(F.lit('{"k":'), k.cast("string"), F.lit("}"))).alias("said"),
    )
    rows = B.table(spark, sf_dir, "events").select("event_id", run.alias("run"))
    return rows.select("event_id", typed.encode_nested(F.col("run"), rows.schema["run"].dataType).alias("nested"))


@query(
    "traceparent",
    """WITH h AS (SELECT event_id, lower(to_hex(event_id)) AS x FROM events)
    SELECT event_id, CASE WHEN event_id > 0 THEN lpad(x, 32, '0') END AS trace_id,
           CASE WHEN event_id > 0 THEN lpad(x, 16, '0') END AS span_id,
           CASE WHEN event_id > 0 THEN '00-' || lpad(x, 32, '0') || '-' || lpad(x, 16, '0') || '-'
             || lpad(lower(to_hex(event_id % 256)), 2, '0') END AS traceparent FROM h""",
)
def traceparent(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.hex("event_id")
    return B.table(spark, sf_dir, "events").select(
        "event_id", scalars.traceparent(h, h, F.col("event_id")).alias("t")
    ).select("event_id", "t.*")


@query(
    "episode_names",
    """SELECT o_orderkey AS episode_id, 'lab/set #' || o_orderkey AS plain,
       CASE o_orderkey % 3 WHEN 0 THEN 'run ' || o_orderkey || ' of lab/set' ELSE 'lab/set #' || o_orderkey END AS named,
       'bag-' || o_orderkey || ' (ros2 bag)' AS bag, 'demo-' || o_orderkey AS stem,
       CASE WHEN o_orderkey % 2 = 0 THEN 'nightly' ELSE 'replay ' || o_orderpriority END || ' · '
         || 'episode-' || o_orderkey AS replay FROM orders""",
)
def episode_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    text = i.cast("string")
    template = F.when(i % 3 == 0, "run {episode_index} of {repo_id}").when(i % 3 == 1, "run {oops}")
    return B.table(spark, sf_dir, "orders").select(
        i.alias("episode_id"),
        scalars.episode_name(F.lit(None).cast("string"), F.lit("lab/set"), i).alias("plain"),
        scalars.episode_name(template, F.lit("lab/set"), i).alias("named"),
        scalars.recording_name(F.concat(F.lit("/data/bag-"), text)).alias("bag"),
        scalars.file_stem(F.concat(F.lit("/data/demo-"), text, F.lit(".hdf5"))).alias("stem"),
        scalars.replay_name(
            F.when(i % 2 == 0, "nightly"), F.col("o_orderpriority"), F.concat(F.lit("episode-"), text)
        ).alias("replay"),
    )
