"""Queries on message recordings and logged rollouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions import flatten as fl
from runlens.functions.classify import classify_topic
from runlens.operators import alignment, outcomes, pack, quality
from runlens.operators.ordering import number_rows
from runlens.plans import bindings as B
from runlens.plans.registry import query
from runlens.sources import recordings as rec

def _count() -> Column:
    return F.count(F.lit(1)).alias("n")


_SLOT_SQL = """CASE WHEN msgtype IN ('sensor_msgs/msg/Image', 'sensor_msgs/msg/CompressedImage') THEN 'video'
  WHEN msgtype IN ('geometry_msgs/msg/Twist', 'geometry_msgs/msg/TwistStamped', 'geometry_msgs/msg/Wrench',
    'geometry_msgs/msg/WrenchStamped', 'trajectory_msgs/msg/JointTrajectory',
    'trajectory_msgs/msg/MultiDOFJointTrajectory', 'control_msgs/msg/JointJog') THEN 'actions'
  WHEN regexp_matches(lower(topic), '(^|/)(cmd_[^/]*|command)$') THEN 'actions' ELSE 'sensors' END"""
_REASON_SQL = """CASE WHEN msgtype LIKE '%Image' OR msgtype LIKE '%/Twist' THEN 'msgtype'
  WHEN regexp_matches(lower(topic), '(^|/)(cmd_[^/]*|command)$') THEN 'topic-name' ELSE 'default' END"""


@query(
    "classify_topic",
    f"""WITH {B.MESSAGES_SQL}
    SELECT topic, msgtype, {_SLOT_SQL} AS slot, {_REASON_SQL} AS reason, count(*) AS n FROM messages GROUP BY ALL""",
)
def classify_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = B.headers(spark, sf_dir)
    return (
        msgs.withColumn("c", classify_topic(F.col("topic"), F.col("msgtype")))
        .groupBy("topic", "msgtype", "c.slot", "c.reason")
        .agg(_count())
    )


def _recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("recording_id"))


_SUMMARY_SQL = f"""{B.MESSAGES_SQL},
  totals AS (SELECT recording_id, count(*) AS message_count, (max(t_ns) - min(t_ns)) / 1e9 AS duration_s FROM messages GROUP BY 1),
  topics AS (SELECT recording_id, topic, msgtype, count(*) AS n, {_SLOT_SQL} AS slot, {_REASON_SQL} AS reason FROM messages GROUP BY ALL),
  summary AS (
    SELECT c_custkey AS recording_id, coalesce(message_count, 0) AS message_count, duration_s, topic, msgtype, n, slot, reason
    FROM customer LEFT JOIN totals t ON t.recording_id = c_custkey LEFT JOIN topics p ON p.recording_id = c_custkey)"""


@query(
    "bag_summary",
    f"""WITH {_SUMMARY_SQL}
    SELECT recording_id, message_count, round(duration_s, 6) AS duration_s, topic, msgtype, n, slot, reason FROM summary""",
)
def bag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rec.bag_summary(B.headers(spark, sf_dir), _recordings(spark, sf_dir))
    return out.withColumn("duration_s", F.round("duration_s", 6))


@query(
    "report_bag",
    f"""WITH {_SUMMARY_SQL},
    ranked AS (SELECT *, CASE slot WHEN 'video' THEN 1 WHEN 'sensors' THEN 2 ELSE 3 END AS rank FROM summary),
    lines AS (
      SELECT DISTINCT recording_id, 0 AS rank, '' AS topic, CASE WHEN duration_s IS NULL THEN recording_id || '  (empty bag)'
        ELSE recording_id || '  ' || format('{{:.2f}}', duration_s::DOUBLE) || 's, ' || message_count || ' message'
             || CASE WHEN message_count = 1 THEN '' ELSE 's' END END AS line FROM ranked
      UNION ALL SELECT DISTINCT recording_id, rank, '', '  ' || slot || ':' FROM ranked WHERE topic IS NOT NULL
      UNION ALL SELECT recording_id, rank, topic, '    ' || topic || '  (' || msgtype || ', ' || n || ' msg, via ' || reason || ')'
      FROM ranked WHERE topic IS NOT NULL)
    SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY rank, topic) - 1 AS line_no, line FROM lines""",
)
def report_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.bag_report(rec.bag_summary(B.headers(spark, sf_dir), _recordings(spark, sf_dir)))


@query(
    "slot_artifacts",
    f"""WITH {_SUMMARY_SQL},
    per AS (
      SELECT recording_id, slot, CASE slot WHEN 'video' THEN 1 WHEN 'sensors' THEN 2 ELSE 3 END AS rank,
             string_agg(topic, ',' ORDER BY topic) AS topics
      FROM summary WHERE topic IS NOT NULL GROUP BY ALL)
    SELECT recording_id, (row_number() OVER (PARTITION BY recording_id ORDER BY rank) - 1)::INT AS artifact_no, slot, topics FROM per""",
)
def slot_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rec.artifacts(rec.bag_summary(B.headers(spark, sf_dir), _recordings(spark, sf_dir)))
    return out.withColumn("topics", F.array_join("topics", ","))


@query(
    "slot_override",
    f"""WITH {B.MESSAGES_SQL}
    SELECT DISTINCT recording_id, topic, 'video' AS slot FROM messages WHERE {_SLOT_SQL} = 'video'
    UNION ALL SELECT DISTINCT recording_id, topic, 'actions' FROM messages WHERE topic IN ('/battery', '/cmd_vel')""",
)
def slot_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = rec.topic_summary(B.headers(spark, sf_dir)).select("recording_id", "topic", "msgtype")
    picked = (
        pack.resolve_slot(topics, "video")
        .unionByName(pack.resolve_slot(topics, "sensors", []))
        .unionByName(pack.resolve_slot(topics, "actions", ["/battery", "/cmd_vel"]))
    )
    return picked.select("recording_id", "topic", "slot")


# ── packing and notes ────────────────────────────────────────────────

_STEADY_SQL = f"""{B.FIELDS_SQL},
  row_counts AS (SELECT recording_id, topic, count(*) AS row_count FROM kept_rows GROUP BY ALL),
  steady AS (
    SELECT recording_id, topic, field FROM kept_fields JOIN row_counts USING (recording_id, topic)
    GROUP BY ALL HAVING count(*) = max(row_count) AND count(DISTINCT shape) = 1),
  numbered AS (
    SELECT *, row_number() OVER (PARTITION BY recording_id, topic ORDER BY t_ns, seq) - 1 AS step FROM kept_rows)"""


@query(
    "pack_messages",
    f"""WITH {_STEADY_SQL}
    SELECT f.recording_id AS episode_id, {_SLOT_SQL} AS slot, topic || '/' || field AS key, count(*) AS n,
           max(step) AS last_step, max(t_ns) AS last_t_ns, round(sum(value[1]::DOUBLE), 3) AS total
    FROM kept_fields f JOIN steady USING (recording_id, topic, field) JOIN numbered USING (recording_id, topic, t_ns, seq)
    GROUP BY ALL""",
)
def pack_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = pack.pack_messages(pack.stored_flat_messages(B.messages(spark, sf_dir)))
    return samples.groupBy("episode_id", "slot", "key").agg(
        _count(),
        F.max("step").alias("last_step"),
        F.max("t_ns").alias("last_t_ns"),
        F.round(F.sum(F.col("value")[0].cast("double")), 3).alias("total"),
    )


_CONSISTENCY_SQL = f"""{B.FIELDS_SQL},
  grid AS (
    SELECT r.*, k.field FROM kept_rows r
    JOIN (SELECT DISTINCT recording_id, topic, field FROM kept_fields) k USING (recording_id, topic)),
  seen AS (
    SELECT g.*, f.shape, first_value(f.shape IGNORE NULLS) OVER w AS first_shape,
           row_number() OVER (PARTITION BY g.recording_id, g.topic, g.field ORDER BY g.t_ns, g.seq) AS pos
    FROM grid g LEFT JOIN kept_fields f USING (recording_id, topic, t_ns, seq, field)
    WINDOW w AS (PARTITION BY g.recording_id, g.topic, g.field ORDER BY g.t_ns, g.seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
  broken AS (
    SELECT recording_id, topic, field, arg_min(shape IS NULL, pos) AS gone, arg_min(coalesce(shape, ''), pos) AS shape,
           any_value(first_shape) AS first_shape
    FROM seen WHERE shape IS NULL OR shape <> first_shape GROUP BY ALL),
  field_issues AS (
    SELECT recording_id, topic, field,
           CASE WHEN gone THEN 'field_absent field=' || field
                ELSE 'field_shape field=' || field || ' found=' || shape || ' expected=' || first_shape END AS reason
    FROM broken)"""


@query("field_consistency", f"WITH {_CONSISTENCY_SQL} SELECT * FROM field_issues")
def field_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pack.usable_rows(pack.stored_flat_messages(B.messages(spark, sf_dir)))
    return quality.field_consistency(rows)


_ISSUES_SQL = f"""{_CONSISTENCY_SQL},
  topic_types AS (SELECT DISTINCT recording_id, topic, msgtype FROM messages),
  all_issues AS (
    SELECT recording_id, {_SLOT_SQL} AS slot, topic AS item,
           'unreadable msgtype=' || msgtype || ' cause=angular.x missing' AS reason
    FROM topic_types SEMI JOIN failed_topics USING (recording_id, topic)
    UNION ALL
    SELECT recording_id, {_SLOT_SQL}, topic, 'no_numbers'
    FROM topic_types ANTI JOIN kept_rows USING (recording_id, topic) WHERE topic <> '/cmd_vel'
    UNION ALL
    SELECT recording_id, {_SLOT_SQL}, topic, reason FROM field_issues JOIN topic_types USING (recording_id, topic)
    UNION ALL
    SELECT recording_id, 'video', '/camera/depth', 'topic_absent' FROM (SELECT DISTINCT recording_id FROM messages)
    UNION ALL
    SELECT recording_id, 'video', '/camera/image_raw', 'topic_absent' FROM (SELECT DISTINCT recording_id FROM messages)
    ANTI JOIN (SELECT recording_id FROM messages WHERE topic = '/camera/image_raw') USING (recording_id)
    UNION ALL
    SELECT recording_id, 'video', topic, 'no_image msgtype=' || msgtype FROM topic_types WHERE topic = '/battery')"""


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = B.messages(spark, sf_dir)
    topics = rec.topic_summary(msgs)
    return (
        pack.message_issues(pack.stored_flat_messages(msgs))
        .unionByName(
            quality.missing_topics(
                topics, topics.select("recording_id").distinct(), "video", ["/camera/image_raw", "/camera/depth"]
            )
        )
        .unionByName(quality.wrong_video_types(topics, ["/camera/image_raw", "/battery"]))
    )


@query("recording_issues", f"WITH {_ISSUES_SQL} SELECT recording_id, slot, item, reason FROM all_issues")
def recording_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(spark, sf_dir)


@query(
    "provenance",
    f"""WITH {_ISSUES_SQL},
    facts AS (SELECT recording_id, count(*) AS message_count, string_agg(DISTINCT topic, ',' ORDER BY topic) AS topics FROM messages GROUP BY 1),
    notes AS (SELECT recording_id, string_agg(item || ': ' || reason, '; ' ORDER BY item || ': ' || reason) AS skipped FROM all_issues GROUP BY 1)
    SELECT recording_id, unnest(['adapter', 'bag', 'message_count', 'operator', 'skipped_topics', 'topics']) AS key,
           unnest(['override', recording_id::VARCHAR, message_count::VARCHAR, 'lab', skipped, topics]) AS value
    FROM facts LEFT JOIN notes USING (recording_id)""",
)
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = B.headers(spark, sf_dir)
    ids = msgs.select("recording_id").distinct()
    given = ids.withColumn(
        "metadata", F.create_map(F.lit("adapter"), F.lit("override"), F.lit("operator"), F.lit("lab"))
    )
    out = rec.provenance(rec.bag_summary(msgs, ids), _issues(spark, sf_dir), "ros2", given)
    return out.select("recording_id", F.explode("metadata").alias("key", "value"))


# ── time ─────────────────────────────────────────────────────────────

_GAPS_SQL = f"""{B.MESSAGES_SQL},
  gaps AS (
    SELECT recording_id, topic, t_ns, seq,
           t_ns - lag(t_ns) OVER (PARTITION BY recording_id, topic ORDER BY t_ns, seq) AS delta FROM messages)"""


@query("msg_deltas", f"WITH {_GAPS_SQL} SELECT recording_id, topic, t_ns, seq, delta FROM gaps WHERE delta > 0")
def msg_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.message_gaps(B.headers(spark, sf_dir))


@query(
    "infer_fps",
    f"""WITH {_GAPS_SQL},
    per AS (
      SELECT recording_id, topic, count(*) AS n, min(t_ns) AS first,
             coalesce(round(1e9::DOUBLE / median(CASE WHEN delta > 0 THEN delta END)::DOUBLE, 2), 10.0::DOUBLE) AS fps
      FROM gaps GROUP BY ALL)
    SELECT recording_id, topic, n, fps,
           row_number() OVER (PARTITION BY recording_id ORDER BY n DESC, first) = 1 AS is_primary FROM per""",
)
def infer_fps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.infer_fps(B.headers(spark, sf_dir))


def _camera_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrist = F.col("event_type") == "purchase"
    return (
        B.headers(spark, sf_dir)
        .where(F.col("event_type").isin("signup", "purchase"))
        .select(
            "recording_id",
            F.when(wrist, "/camera/wrist").otherwise("/camera/front").alias("topic"),
            "t_ns",
            "seq",
            F.when(wrist, 48).otherwise(32).alias("width"),
            F.when(wrist, 30).otherwise(24).alias("height"),
        )
    )


@query(
    "camera_frames",
    f"""WITH {B.MESSAGES_SQL},
    cams AS (
      SELECT recording_id, CASE event_type WHEN 'purchase' THEN '/camera/wrist' ELSE '/camera/front' END AS topic, seq,
             row_number() OVER (PARTITION BY recording_id, event_type ORDER BY t_ns, seq) - 1 AS frame
      FROM messages WHERE event_type IN ('signup', 'purchase')),
    n AS (
      SELECT recording_id, min(c) AS n, sum(CASE topic WHEN '/camera/wrist' THEN 48 ELSE 32 END)::BIGINT AS total_width,
             max(CASE topic WHEN '/camera/wrist' THEN 30 ELSE 24 END) AS max_height
      FROM (SELECT recording_id, topic, count(*) AS c FROM cams GROUP BY ALL) GROUP BY 1)
    SELECT recording_id, frame, total_width, max_height, string_agg(topic || '#' || seq, ' ' ORDER BY topic) AS cells
    FROM cams JOIN n USING (recording_id) WHERE frame < n GROUP BY ALL""",
)
def camera_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.camera_frames(_camera_frames(spark, sf_dir))
    cells = F.transform("cells", lambda c: F.concat_ws("#", c["topic"], c["seq"].cast("string")))
    return out.withColumn("cells", F.array_join(cells, " "))


# ── flattening ───────────────────────────────────────────────────────

def _total() -> Column:
    """Sum of all numbers of ``value``."""
    return F.aggregate(F.col("value").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)



@query(
    "flatten_dispatch",
    f"""WITH {B.FIELDS_SQL}
    SELECT msgtype, field, count(*) AS n, max(len(value))::INT AS width, round(sum(list_sum(value::DOUBLE[])), 3) AS total
    FROM fields f WHERE NOT (msgtype = 'geometry_msgs/msg/Twist' AND seq % 501 = 0) GROUP BY ALL""",
)
def flatten_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = pack.flat_messages(B.messages(spark, sf_dir))
    # The outer form adds no size filter, which would flatten every message twice.
    long = flat.select("msgtype", F.inline_outer("fields")).where(F.col("field").isNotNull())
    return long.groupBy("msgtype", "field").agg(
        _count(),
        F.max(F.size("value")).alias("width"),
        F.round(F.sum(_total()), 3).alias("total"),
    )


@query(
    "flatten_generic",
    """SELECT field, count(*) AS n, round(sum(x), 3) AS total FROM (
      SELECT unnest(['k', 'grip.k', 'on', 'deep.a.b']) AS field,
             unnest([json_extract(props, '$.k')::DOUBLE, json_extract(props, '$.k')::DOUBLE, 1.0, value::FLOAT::DOUBLE]) AS x
      FROM events) GROUP BY 1
    UNION ALL SELECT 'list', count(*), round(sum(value::FLOAT::DOUBLE + 2), 3) FROM events""",
)
def flatten_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value").cast("string")
    props = F.col("props")
    body = F.concat(
        F.lit('{"grip":'), props, F.lit(',"name":"x","none":null,"_private":5,"on":true,"deep":{"a":{"b":'), v,
        F.lit('}},"list":['), v, F.lit(',2],"parts":[{"x":1}],'), F.substring_index(props, "{", -1),
    )
    parsed = B.events(spark, sf_dir).select(F.parse_json(body).alias("payload"))
    flat = parsed.select(fl.generic(F.col("payload"))["fields"].alias("fields"))
    return (
        flat.select(F.inline_outer("fields"))
        .where(F.col("field").isNotNull())
        .groupBy("field")
        .agg(
            _count(),
            F.round(F.sum(_total()), 3).alias("total"),
        )
    )


def _flatten_query(name: str, cases: list[tuple[str, str, list[tuple[str, int, int]], str | None]]) -> None:
    """Register a flattener over payloads built from every event's value.

    A case is (msgtype, payload with ``@`` for the value, expected fields as
    (name, width, how often the value occurs), expected failure).
    """
    n = len(cases)
    inputs = ",".join(f"({i},'{m}','{p}')" for i, (m, p, _, _) in enumerate(cases))
    wanted = []
    for i, (m, _, fields, failed) in enumerate(cases):
        why = f"'{failed}'" if failed else "NULL"
        if not fields:
            wanted.append(f"({i},'{m}',NULL,NULL,NULL,{why})")
        wanted += [f"({i},'{m}','{f}',{w},{k},{why})" for f, w, k in fields]
    oracle = f"""SELECT msgtype, field, width, failed, count(*) AS n, round(sum(times * value::FLOAT::DOUBLE), 3) AS total
      FROM events e JOIN (VALUES {",".join(wanted)}) AS w(i, msgtype, field, width, times, failed) ON e.event_id % {n} = w.i
      GROUP BY ALL"""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ev = B.cases(spark, sf_dir, inputs, "msgtype, template", n)
        body = F.parse_json(F.replace(F.col("template"), F.lit("@"), F.col("value").cast("string")))
        # A column of its own: inside the flattener it would be parsed per field.
        parsed = ev.select("msgtype", body.alias("payload"))
        flat = parsed.withColumn("f", fl.flatten_message(F.col("msgtype"), F.col("payload")))
        long = flat.select("msgtype", "f.failed", F.inline_outer("f.fields"))
        return (
            long.withColumn("width", F.when(F.col("value").isNotNull(), F.size("value")))
            .groupBy("msgtype", "field", "width", "failed")
            .agg(_count(), F.round(F.sum(_total()), 3).alias("total"))
        )

    query(name, oracle)(run)


_V3 = '{"x":@,"y":@,"z":0}'
_Q4 = '{"x":0,"y":0,"z":0,"w":@}'

_flatten_query(
    "flatten_joint",
    [
        ("sensor_msgs/msg/JointState", '{"position":[@,@,@],"velocity":[@],"effort":[]}', [("position", 3, 3), ("velocity", 1, 1)], None),
        ("sensor_msgs/msg/JointState", '{"position":[],"velocity":null}', [], None),
        ("sensor_msgs/msg/JointState", '{"effort":[@,@]}', [("effort", 2, 2)], None),
        ("sensor_msgs/msg/JointState", '{"position":"x"}', [], "position is not a list of numbers"),
    ],
)
_flatten_query(
    "flatten_imu",
    [
        ("sensor_msgs/msg/Imu", f'{{"orientation":{_Q4},"angular_velocity":{_V3},"linear_acceleration":{_V3}}}',
         [("orientation", 4, 1), ("angular_velocity", 3, 2), ("linear_acceleration", 3, 2)], None),
        ("sensor_msgs/msg/Imu", f'{{"orientation":{_Q4}}}', [("orientation", 4, 1)], None),
        ("sensor_msgs/msg/Imu", '{"angular_velocity":{"x":@,"y":1}}', [], "angular_velocity.z missing"),
    ],
)
_flatten_query(
    "flatten_twist",
    [
        ("geometry_msgs/msg/Twist", f'{{"linear":{_V3},"angular":{_V3}}}', [("linear", 3, 2), ("angular", 3, 2)], None),
        ("geometry_msgs/msg/TwistStamped", f'{{"twist":{{"linear":{_V3},"angular":{_V3}}}}}', [("linear", 3, 2), ("angular", 3, 2)], None),
        ("geometry_msgs/msg/Twist", f'{{"linear":{_V3}}}', [], "angular.x missing"),
    ],
)
_flatten_query(
    "flatten_wrench",
    [
        ("geometry_msgs/msg/Wrench", f'{{"force":{_V3},"torque":{_V3}}}', [("force", 3, 2), ("torque", 3, 2)], None),
        ("geometry_msgs/msg/WrenchStamped", f'{{"wrench":{{"force":{_V3},"torque":{_V3}}}}}', [("force", 3, 2), ("torque", 3, 2)], None),
        ("geometry_msgs/msg/WrenchStamped", f'{{"force":{_V3}}}', [], "wrench.force.x missing"),
    ],
)
_flatten_query(
    "flatten_pose",
    [
        ("geometry_msgs/msg/PoseStamped", f'{{"pose":{{"position":{_V3},"orientation":{_Q4}}}}}', [("position", 3, 2), ("orientation", 4, 1)], None),
        ("geometry_msgs/msg/PoseStamped", f'{{"pose":{{"position":{_V3}}}}}', [], "pose.orientation.x missing"),
    ],
)
_flatten_query(
    "flatten_odom",
    [
        ("nav_msgs/msg/Odometry",
         f'{{"pose":{{"pose":{{"position":{_V3},"orientation":{_Q4}}}}},"twist":{{"twist":{{"linear":{_V3},"angular":{_V3}}}}}}}',
         [("position", 3, 2), ("orientation", 4, 1), ("linear_velocity", 3, 2), ("angular_velocity", 3, 2)], None),
        ("nav_msgs/msg/Odometry", "{}", [], "pose.pose.position.x missing"),
    ],
)


# ── keys, steps and rollouts ─────────────────────────────────────────


@query(
    "key_union",
    f"WITH {B.TALK_SQL} SELECT episode_id, string_agg(DISTINCT key, ',' ORDER BY key) AS keys FROM sensors GROUP BY 1",
)
def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = B.talk_sensors(spark, sf_dir).select("episode_id", "key").distinct()
    return keys.groupBy("episode_id").agg(F.array_join(F.sort_array(F.collect_list("key")), ",").alias("keys"))


@query(
    "step_number",
    f"WITH {B.line_sql('l_orderkey')} SELECT episode_id, step, l_partkey, l_linenumber, l_suppkey FROM steps",
)
def step_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.line_steps(spark, sf_dir, "l_orderkey").select("episode_id", "step", "l_partkey", "l_linenumber", "l_suppkey")


def _talk_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step per turn; the speaker's key is present in that step only."""
    talks = B.table(spark, sf_dir, "conversations")
    step = number_rows(talks, ["conv_id"], ["turn"])
    return step.select(
        F.col("conv_id").alias("episode_id"),
        "step",
        F.inline(
            F.array(
                F.struct(F.lit("observation.length").alias("key"), F.array(F.length("text").cast("float")).alias("value")),
                F.struct(F.concat(F.lit("observation."), F.col("role")).alias("key"), F.array(F.lit(1.0).cast("float")).alias("value")),
                F.struct(F.lit("action").alias("key"), F.array((F.length("text") % 10).cast("float")).alias("value")),
            )
        ),
    )


@query(
    "pack_rollout",
    """WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS step FROM conversations),
    n AS (SELECT conv_id, count(*) AS turns FROM t GROUP BY 1),
    one AS (SELECT conv_id, role FROM t JOIN n USING (conv_id) GROUP BY ALL HAVING count(*) = max(turns))
    SELECT conv_id AS episode_id, 'observation.length/value' AS key, step, step * 33333333 AS t_ns, length(text)::DOUBLE AS x FROM t
    UNION ALL SELECT conv_id, 'action/value', step, step * 33333333, length(text) % 10 FROM t
    UNION ALL SELECT conv_id, 'observation.' || role || '/value', step, step * 33333333, 1 FROM t SEMI JOIN one USING (conv_id, role)""",
)
def pack_rollout(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack.pack_rollout(_talk_steps(spark, sf_dir))
    return out.select("episode_id", "key", "step", "t_ns", F.col("value")[0].cast("double").alias("x"))


@query(
    "rollout_totals",
    f"""WITH {B.MESSAGES_SQL},
    s AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY t_ns, seq) - 1 AS step FROM messages),
    stop AS (SELECT recording_id, min(step) FILTER (event_type = 'error') AS stop FROM s WHERE step < 10000 GROUP BY 1)
    SELECT recording_id AS episode_id, round(sum(value), 4) AS total_reward, count(*) AS steps,
           arg_max(event_type = 'error', step) AS terminated, false AS truncated, round(count(*) / 30.0, 6) AS duration_s
    FROM s JOIN stop USING (recording_id) WHERE step < 10000 AND (stop IS NULL OR step <= stop) GROUP BY 1""",
)
def rollout_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = number_rows(B.headers(spark, sf_dir), ["recording_id"], ["t_ns", "seq"]).select(
        F.col("recording_id").alias("episode_id"),
        "step",
        F.col("value").alias("reward"),
        (F.col("event_type") == "error").alias("terminated"),
        F.lit(False).alias("truncated"),
    )
    out = outcomes.rollout_totals(steps)
    return out.withColumn("total_reward", F.round("total_reward", 4)).withColumn("duration_s", F.round("duration_s", 6))


@query(
    "flatten_space",
    """SELECT l_suppkey, key, count(*) AS n, round(sum(x), 2) AS total FROM (
      SELECT l_suppkey, unnest(['observation.pose.xyz', 'observation.pose.grid', 'observation.mode', 'observation.pair.0', 'observation.pair.1']) AS key,
             unnest([l_quantity + l_linenumber, 2 * l_quantity + 1, l_linenumber, l_quantity, 2 * l_linenumber]) AS x
      FROM lineitem) GROUP BY ALL""",
)
def flatten_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    value = F.struct(
        F.struct(
            F.array(q, n.cast("double")).alias("xyz"),
            F.array(F.array(q, F.lit(1.0)), F.array(q)).alias("grid"),
        ).alias("pose"),
        n.alias("mode"),
        F.struct(q.alias("_1"), F.array(n, n).alias("_2")).alias("pair"),
    )
    rows = B.table(spark, sf_dir, "lineitem").select("l_suppkey", value.alias("obs"))
    keyed = fl.flatten_space(F.col("obs"), rows.schema["obs"].dataType, "observation")
    long = rows.select(
        "l_suppkey",
        F.inline(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in keyed])),
    )
    return long.groupBy("l_suppkey", "key").agg(_count(), F.round(F.sum(_total()), 2).alias("total"))
