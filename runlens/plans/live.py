"""Streaming queries, driven to completion over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.plans import bindings as B
from runlens.plans import staging
from runlens.plans.registry import query
from runlens.streaming import live

GAP = "6 hours"
DELAY = "12 hours"


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = B.table(spark, sf_dir, "events").schema
    raw = live.file_stream(spark, sf_dir, schema, "events.parquet")
    return B.message_columns(raw.withColumn("ts", F.col("ts").cast("timestamp")))


BATCHES = 5


# Rows of one arrived file; an arrival of more is written as several files by several tasks.
ROWS_PER_FILE = 500_000


def _inbox(spark: SparkSession, sf_dir: str, rows_per_file: int = ROWS_PER_FILE) -> tuple[str, T.StructType, int]:
    """The events as five arrivals in turn: a fifth of the time each, but every seventh message one arrival late.

    All arrivals have the same number of files, which is returned last.
    """
    events = B.table(spark, sf_dir, "events")
    lo, hi = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    time = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(lo or 0)
    part = F.floor(time * BATCHES / F.lit((hi or 0) - (lo or 0) + 1)) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    dealt = events.withColumn("_part", F.least(F.lit(BATCHES - 1), part))
    sizes = dict(dealt.groupBy("_part").count().collect())
    # By the smallest arrival, so that no file is left out for want of rows.
    files = max(1, min(sizes.get(k, 0) for k in range(BATCHES)) // rows_per_file)
    inbox = staging.fresh(spark, "inbox")
    for k in range(BATCHES):
        arrived = dealt.where(F.col("_part") == k).drop("_part")
        arrived = arrived.coalesce(1) if files == 1 else arrived.repartition(files)
        arrived.write.mode("append").parquet(inbox)
    return inbox, events.schema, files


def _run(stream: DataFrame, spark: SparkSession, mode: str = "append", name: str = "rows") -> DataFrame:
    out = staging.fresh(spark, "stream")
    schema = stream.schema
    live.drain(stream, live.folder_writer(out, name), f"{out}/checkpoint", mode)
    return live.stored(spark, out, name, schema)


@query(
    "stream_ingest",
    f"""WITH {B.MESSAGES_SQL} SELECT recording_id, topic, count(*) AS n, max(t_ns) AS last_ns
    FROM messages WHERE topic IN ('/joint_states', '/cmd_vel') GROUP BY ALL""",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = live.ingest(_stream(spark, sf_dir), B.headers(spark, sf_dir), ["/joint_states", "/cmd_vel"])
    rows = _run(kept.select("recording_id", "topic", "t_ns"), spark)
    return rows.groupBy("recording_id", "topic").agg(F.count(F.lit(1)).alias("n"), F.max("t_ns").alias("last_ns"))


@query(
    "stream_topic_counts",
    f"WITH {B.MESSAGES_SQL} SELECT recording_id, topic, count(*) AS n FROM messages GROUP BY ALL",
)
def stream_topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted over five batches; the counts are read from the state store."""
    inbox, schema, files = _inbox(spark, sf_dir)
    stream = B.message_columns(live.file_stream(spark, inbox, schema, files_per_batch=files).withColumn("ts", F.col("ts").cast("timestamp")))
    checkpoint = staging.fresh(spark, "counts")
    live.drain(live.topic_counts(stream), None, checkpoint, "update")
    return live.held_counts(spark, checkpoint)


@query(
    "stream_sessions",
    f"""WITH {B.MESSAGES_SQL},
    marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY recording_id ORDER BY ts, seq) < INTERVAL {GAP} THEN 0 ELSE 1 END AS fresh FROM messages),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY recording_id ORDER BY ts, seq) AS session FROM marked)
    SELECT recording_id, count(*) AS message_count, min(t_ns) AS first_ns, max(t_ns) AS last_ns,
           round((max(t_ns) - min(t_ns)) / 1e9, 6) AS duration_s
    FROM numbered GROUP BY recording_id, session
    HAVING max(ts) + INTERVAL {GAP} <= date_trunc('millisecond', (SELECT max(ts) FROM messages)) - INTERVAL {DELAY}""",
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _run(live.closed_sessions(_stream(spark, sf_dir), GAP, DELAY), spark)
    return rows.drop("batch").withColumn("duration_s", F.round("duration_s", 6))


@query(
    "stream_late",
    f"""WITH span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
    e AS (
      SELECT ts, event_id, least({BATCHES - 1}, (epoch_us(ts) - lo) * {BATCHES} // (hi - lo + 1) + (event_id % 7 = 0)::INT) AS part
      FROM events, span),
    clocks AS (SELECT part, max(ts) AS latest FROM e GROUP BY part),
    marks AS (
      SELECT a.part, date_trunc('millisecond', max(b.latest)) - INTERVAL 2 DAY AS w
      FROM clocks a JOIN clocks b ON b.part < a.part GROUP BY a.part)
    SELECT e.part AS batch, count(*) FILTER (w IS NULL OR ts > w) AS kept, count(*) FILTER (ts <= w) AS dropped,
           min(event_id) FILTER (ts <= w) AS first_dropped
    FROM e LEFT JOIN marks USING (part) GROUP BY e.part""",
)
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five arrivals; what comes behind its batch's watermark goes to a side output."""
    inbox, schema, files = _inbox(spark, sf_dir)
    out = staging.fresh(spark, "late")
    raw = live.file_stream(spark, inbox, schema, files_per_batch=files).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = B.message_columns(raw).select("seq", "ts")
    live.drain(rows, live.late_splitter(out, 2 * 24 * 3600 * 1000), f"{out}/checkpoint")
    return live.split_rows(spark, out, rows.schema).groupBy("batch").agg(
        F.count_if(~F.col("late")).alias("kept"),
        F.count_if("late").alias("dropped"),
        F.min(F.when(F.col("late"), F.col("seq"))).alias("first_dropped"),
    )


@query(
    "stream_finalize",
    f"""WITH {B.MESSAGES_SQL},
    stops AS (
      SELECT recording_id, min(t_ns) AS stop_ns, arg_min(seq, t_ns) AS seq FROM messages WHERE event_type = 'error' GROUP BY 1),
    totals AS (
      SELECT m.recording_id, s.seq, count(*) FILTER (t_ns <= stop_ns) AS message_count, count(*) FILTER (t_ns > stop_ns) AS late_count,
             (max(t_ns) FILTER (t_ns <= stop_ns) - min(t_ns) FILTER (t_ns <= stop_ns)) / 1e9 AS duration_s
      FROM messages m JOIN stops s USING (recording_id) WHERE event_type <> 'error' GROUP BY ALL)
    SELECT recording_id, CASE WHEN seq % 2 = 0 THEN 'ready' ELSE 'failed' END AS status, message_count, late_count,
           round(duration_s, 6) AS duration_s,
           CASE WHEN seq % 2 = 1 THEN 'failure_reason=RuntimeError' || CASE WHEN seq % 3 = 0 THEN ': motor ' || seq ELSE '' END || ';' ELSE '' END
             || CASE WHEN recording_id % 4 = 0 THEN 'mode=shadow' ELSE 'mode=live' END AS metadata
    FROM totals WHERE message_count > 0""",
)
def stream_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five arrivals, some rows a batch late, and last a row that only moves the clock."""
    inbox, schema, files = _inbox(spark, sf_dir)
    # Behind every message and its delay.
    spark.sql("SELECT -1L AS event_id, TIMESTAMP_NTZ'2200-01-01' AS ts").write.mode("append").parquet(inbox)
    raw = live.file_stream(spark, inbox, schema, files_per_batch=files).withColumn("ts", F.col("ts").cast("timestamp"))
    stop = F.when(F.col("seq") >= 0, F.col("event_type") == "error")
    broken = stop & (F.col("seq") % 2 == 1)
    stream = B.message_columns(raw).select(
        "recording_id",
        "t_ns",
        "seq",
        stop.alias("is_stop"),
        F.when(broken, "RuntimeError").alias("exc_type"),
        F.when(broken & (F.col("seq") % 3 == 0), F.concat(F.lit("motor "), F.col("seq").cast("string"))).alias("exc_message"),
    )
    out = staging.fresh(spark, "finalize")
    live.append_rows(live.closed_recordings(stream, "20 days", salts=2), f"{out}/closed", f"{out}/checkpoint")
    given = B.headers(spark, sf_dir).select("recording_id").distinct().where("recording_id % 4 = 0")
    given = given.withColumn("metadata", F.create_map(F.lit("mode"), F.lit("shadow")))
    done = live.finalized(spark.read.schema(live.CLOSED).parquet(f"{out}/closed"), given)
    pairs = F.transform(F.map_entries("metadata"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return done.withColumn("duration_s", F.round("duration_s", 6)).withColumn(
        "metadata", F.array_join(F.sort_array(pairs), ";")
    )


@query(
    "stream_result_upsert",
    f"""SELECT l_returnflag AS eval_run_id, l_suppkey AS baseline_episode_id, l_linestatus AS status, l_extendedprice AS reward
    FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_suppkey
            ORDER BY {", ".join(c + " DESC" for c in B.LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
)
def stream_result_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results arrive twice, as retried pushes do, over five batches; the state store has the last of each."""
    lines = B.table(spark, sf_dir, "lineitem")
    order = [c for c in B.LINE_ORDER if c not in ("l_returnflag", "l_suppkey")]
    inbox, checkpoint = staging.fresh(spark, "pushes"), staging.fresh(spark, "results")
    keys = ["eval_run_id", "baseline_episode_id"]
    # Twice the lines in five batches: each has two files for as many rows as one task writes.
    files = max(1, lines.count() // (BATCHES * ROWS_PER_FILE))
    for _ in range(2):
        lines.repartition(BATCHES * files, "l_orderkey").write.mode("append").parquet(inbox)
    pushed = live.file_stream(spark, inbox, lines.schema, files_per_batch=2 * files).select(
        F.col("l_returnflag").alias("eval_run_id"),
        F.col("l_suppkey").alias("baseline_episode_id"),
        F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("reward"),
        *[F.col(c).alias(f"_{c}") for c in order],
    )
    live.drain(live.latest_results(pushed, keys, [f"_{c}" for c in order]), None, checkpoint, "update")
    return live.held_results(spark, checkpoint).select(*keys, "status", "reward")
