"""The given tables seen as recordings, episodes and samples.

Each binding has a SQL fragment with the same meaning for the oracles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators.ordering import number_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Stored times carry no zone; they are read as UTC whatever the session says.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ── events as a message stream ───────────────────────────────────────

TOPICS = {
    "signup": ("/camera/image_raw", "sensor_msgs/msg/Image"),
    "view": ("/joint_states", "sensor_msgs/msg/JointState"),
    "click": ("/cmd_vel", "geometry_msgs/msg/Twist"),
    "purchase": ("/battery", "sensor_msgs/msg/BatteryState"),
    "error": ("/arm/command", "custom_msgs/msg/Grip"),
}


def _by_event(pick: int) -> Column:
    out = None
    for event, pair in TOPICS.items():
        cond = F.col("event_type") == event
        out = F.when(cond, pair[pick]) if out is None else out.when(cond, pair[pick])
    return out


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def message_columns(df: DataFrame) -> DataFrame:
    """Message columns of an events table, without payloads."""
    return df.select(
        F.col("user_id").alias("recording_id"),
        _by_event(0).alias("topic"),
        _by_event(1).alias("msgtype"),
        (F.unix_micros("ts") * 1000).alias("t_ns"),
        F.col("event_id").alias("seq"),
        "ts",
        "event_type",
        "value",
        "props",
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_columns(events(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a payload per type.

    Joint states change width at seq % 97 = 0 and lack their only field at
    seq % 89 = 0; twists lack ``angular`` at seq % 501 = 0; commands nest the
    JSON text of ``props``.
    """
    v = F.col("value")
    seq = F.col("seq")
    pos = (
        F.when(seq % 89 == 0, F.lit(None).cast("array<double>"))
        .when(seq % 97 == 0, F.array(v, v))
        .otherwise(F.array(v))
    )
    none = F.lit(None).cast("double")
    zero = F.lit(0.0)
    linear = F.struct(v.alias("x"), zero.alias("y"), zero.alias("z"))
    angular = F.struct(zero.alias("x"), zero.alias("y"), v.alias("z"))
    body = (
        F.when(F.col("event_type") == "view", F.to_json(F.struct(pos.alias("position"))))
        .when(
            F.col("event_type") == "click",
            F.when(seq % 501 == 0, F.to_json(F.struct(linear.alias("linear")))).otherwise(
                F.to_json(F.struct(linear.alias("linear"), angular.alias("angular")))
            ),
        )
        .when(
            F.col("event_type") == "purchase",
            F.to_json(
                F.struct(
                    v.alias("percentage"),
                    (v > 50).alias("charging"),
                    F.lit("unit-a").alias("serial"),
                    F.struct(F.when(seq % 7 == 0, none).otherwise(v * 2).alias("volts")).alias("cell"),
                    F.lit(1).alias("_hidden"),
                )
            ),
        )
        .when(
            F.col("event_type") == "error",
            F.concat(F.lit('{"grip":'), F.col("props"), F.lit(',"gain":[1,2.5]}')),
        )
        .otherwise(F.lit('{"height":24,"width":32,"encoding":"bgr8"}'))
    )
    return headers(spark, sf_dir).select(
        "recording_id", "topic", "msgtype", "t_ns", "seq", F.parse_json(body).alias("payload")
    )


def _case(pick: int) -> str:
    whens = " ".join(f"WHEN '{e}' THEN '{pair[pick]}'" for e, pair in TOPICS.items())
    return f"CASE event_type {whens} END"


MESSAGES_SQL = f"""messages AS (
  SELECT user_id AS recording_id, {_case(0)} AS topic, {_case(1)} AS msgtype,
         epoch_us(ts) * 1000 AS t_ns, event_id AS seq, ts, event_type, value, props
  FROM events)"""

# Flat fields of every message: one row per (message, field).
FIELDS_SQL = (
    MESSAGES_SQL
    + """,
fields AS (
  SELECT recording_id, topic, msgtype, t_ns, seq, 'position' AS field,
         CASE WHEN seq % 97 = 0 THEN [value::FLOAT, value::FLOAT] ELSE [value::FLOAT] END AS value,
         CASE WHEN seq % 97 = 0 THEN '(2,)' ELSE '(1,)' END AS shape
  FROM messages WHERE event_type = 'view' AND seq % 89 <> 0
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'linear', [value::FLOAT, 0::FLOAT, 0::FLOAT], '(3,)'
  FROM messages WHERE event_type = 'click'
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'angular', [0::FLOAT, 0::FLOAT, value::FLOAT], '(3,)'
  FROM messages WHERE event_type = 'click' AND seq % 501 <> 0
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'percentage', [value::FLOAT], '()'
  FROM messages WHERE event_type = 'purchase'
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'charging', [(value > 50)::INT::FLOAT], '()'
  FROM messages WHERE event_type = 'purchase'
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'cell.volts', [(value * 2)::FLOAT], '()'
  FROM messages WHERE event_type = 'purchase' AND seq % 7 <> 0
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'grip.k', [json_extract(props, '$.k')::DOUBLE::FLOAT], '()'
  FROM messages WHERE event_type = 'error'
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'gain', [1::FLOAT, 2.5::FLOAT], '(2,)'
  FROM messages WHERE event_type = 'error'
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'height', [24::FLOAT], '()'
  FROM messages WHERE event_type = 'signup'
  UNION ALL SELECT recording_id, topic, msgtype, t_ns, seq, 'width', [32::FLOAT], '()'
  FROM messages WHERE event_type = 'signup'),
failed_topics AS (
  SELECT DISTINCT recording_id, topic FROM messages WHERE event_type = 'click' AND seq % 501 = 0),
kept_fields AS (
  SELECT f.* FROM fields f ANTI JOIN failed_topics x USING (recording_id, topic)),
kept_rows AS (
  SELECT DISTINCT recording_id, topic, t_ns, seq FROM kept_fields)"""
)

# ── line items as numbered steps ─────────────────────────────────────

LINE_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


# What sensors and actions of line items are made of.
LINE_VALUES = ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_extendedprice")


def line_steps(
    spark: SparkSession, sf_dir: str, episode: str = "l_suppkey", keep: Sequence[str] | None = None, last: str | None = None
) -> DataFrame:
    """Line items with ``episode_id`` and a 0-based ``step``; ``keep`` names the columns that are needed besides.

    ``last`` names a column that marks the last step of each episode.
    """
    lines = table(spark, sf_dir, "lineitem")
    lead = "l_orderkey" if episode != "l_orderkey" else "l_partkey"
    # The episode's own column is the same in all its rows, so it decides no order and is not shuffled twice.
    order = [lead, *[c for c in LINE_ORDER if c not in (lead, episode)]]
    if keep is None or episode in keep:
        numbered = number_rows(lines, [episode], order, keep=keep, last=last)
        return numbered.withColumn("episode_id", F.col(episode))
    return number_rows(lines, [episode], order, keep=[episode, *keep], last=last).withColumnRenamed(episode, "episode_id")


def line_sql(episode: str = "l_suppkey") -> str:
    lead = "l_orderkey" if episode != "l_orderkey" else "l_partkey"
    order = ", ".join([lead, *[c for c in LINE_ORDER if c != lead]])
    return f"""steps AS (
  SELECT {episode} AS episode_id,
         row_number() OVER (PARTITION BY {episode} ORDER BY {order}) - 1 AS step, *
  FROM lineitem)"""


def line_actions(steps: DataFrame) -> DataFrame:
    """Baseline action series of numbered line items, in one pass."""
    return steps.select(
        "episode_id",
        "step",
        F.explode(
            F.array(
                F.struct(
                    F.lit("/cmd_vel/linear").alias("key"),
                    F.array("l_quantity", "l_discount", "l_tax").alias("value"),
                ),
                F.struct(
                    F.lit("/grip/value").alias("key"), F.array("l_extendedprice").alias("value")
                ),
            )
        ).alias("s"),
    ).select("episode_id", "step", "s.key", "s.value")


def line_candidate(steps: DataFrame) -> DataFrame:
    """Candidate series; the grip value comes under its namespace only."""
    q = F.col("l_quantity") + F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    return steps.select(
        "episode_id",
        "step",
        F.explode(
            F.array(
                F.struct(
                    F.lit("/cmd_vel/linear").alias("key"),
                    F.array(q, F.col("l_discount"), F.col("l_tax") * 2).alias("value"),
                ),
                F.struct(F.lit("/grip").alias("key"), F.array(F.col("l_extendedprice") + 1).alias("value")),
            )
        ).alias("s"),
    ).select("episode_id", "step", "s.key", "s.value")


# ── conversations as sensors of unequal length ───────────────────────


def talk_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("episode_id"),
        F.concat(F.lit("/"), F.col("role"), F.lit("/n_chars")).alias("key"),
        "turn",
        F.array(F.length("text").cast("float")).alias("value"),
    )
    return number_rows(talks, ["episode_id", "key"], ["turn"]).drop("turn")


TALK_SQL = """sensors AS (
  SELECT conv_id AS episode_id, '/' || role || '/n_chars' AS key,
         row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS step,
         length(text)::FLOAT AS x
  FROM conversations)"""

# ── labels as outcome metadata ───────────────────────────────────────


def outcome_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, metadata VARIANT, sentinel VARIANT)``."""
    b = F.when(F.col("quality") == 1, "true").otherwise("false")
    d = F.col("doc_id").cast("string")
    tox = F.concat(F.lit(',"collision_count":'), F.col("toxic").cast("string"))
    body = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit('{"success":'), b, tox, F.lit("}")))
        .when(
            F.col("doc_id") % 4 == 1,
            F.concat(F.lit('{"outcome":{"success":'), b, F.lit(',"reward_total":'), d, F.lit("}"), tox, F.lit("}")),
        )
        .when(
            F.col("doc_id") % 4 == 2,
            F.concat(
                F.lit('{"lerobot_episode_outcome":{"next.success":'),
                b,
                F.lit(',"next.reward_sum":'),
                d,
                F.lit("}"),
                tox,
                F.lit("}"),
            ),
        )
        .otherwise(F.concat(F.lit('{"success":"true","reward":true'), tox, F.lit("}")))
    )
    sentinel = F.when(
        F.col("doc_id") % 6 == 0, F.lit('{"success":null,"reward_total":null}')
    ).when(F.col("doc_id") % 3 == 0, F.concat(F.lit('{"success":true,"reward_total":'), d, F.lit(".5}")))
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.parse_json(body).alias("metadata"), F.parse_json(sentinel).alias("sentinel")
    )


OUTCOME_SQL = """outcomes AS (
  SELECT doc_id,
         CASE WHEN doc_id % 4 = 3 THEN NULL ELSE quality = 1 END AS success,
         CASE doc_id % 4 WHEN 0 THEN NULL WHEN 3 THEN 1.0 ELSE doc_id END::DOUBLE AS reward_total,
         toxic::DOUBLE AS collision_count
  FROM labels),
mirrored AS (
  SELECT doc_id, success AS success_baseline, reward_total AS reward_baseline,
         collision_count AS collision_baseline,
         CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN true ELSE success END AS success_candidate,
         CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN doc_id + 0.5 ELSE reward_total END::DOUBLE AS reward_candidate,
         collision_count AS collision_candidate
  FROM outcomes)"""

# ── orders as catalogued episodes ────────────────────────────────────


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "O", "ready")
        .when(F.col("o_orderstatus") == "F", "failed")
        .otherwise("recording")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("episode_id"),
        F.concat(F.lit("run "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("policy_version"),
        status.alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") % 100 - 10).alias("failure_time_s"),
        F.lit(60.0).alias("duration_s"),
        F.col("o_custkey").alias("seed"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "critical").otherwise("warning").alias("severity"),
        F.col("o_orderdate").cast("timestamp").alias("at"),
    )


EPISODES_SQL = """episodes AS (
  SELECT o_orderkey AS episode_id, 'run ' || o_orderkey AS name, o_orderpriority AS policy_version,
         CASE o_orderstatus WHEN 'O' THEN 'ready' WHEN 'F' THEN 'failed' ELSE 'recording' END AS status,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice % 100 - 10 END AS failure_time_s,
         60.0::DOUBLE AS duration_s, o_custkey AS seed,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'critical' ELSE 'warning' END AS severity,
         o_orderdate AS at
  FROM orders)"""

# ── literal cases applied to every event ─────────────────────────────


def cases(spark: SparkSession, sf_dir: str, values: str, columns: str, n: int) -> DataFrame:
    """Every event with the literal row numbered ``event_id % n``.

    The literal table has a fixed size, so broadcasting it is always safe.
    """
    lit = spark.sql(f"SELECT * FROM (VALUES {values}) AS t(i, {columns})")
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return ev.join(F.broadcast(lit), F.col("event_id") % n == F.col("i")).drop("i")


def cases_sql(values: str, columns: str, n: int) -> str:
    return (
        f"cases AS (SELECT e.event_id, e.value, c.* EXCLUDE (i) FROM events e "
        f"JOIN (VALUES {values}) AS c(i, {columns}) ON e.event_id % {n} = c.i)"
    )
