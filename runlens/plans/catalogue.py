"""Queries on the episode catalogue."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens import model
from runlens.operators import catalog, sink
from runlens.plans import bindings as B
from runlens.plans import staging
from runlens.plans.registry import query


@query(
    "failure_time",
    f"""WITH {B.EPISODES_SQL},
    t AS (SELECT episode_id, CASE WHEN episode_id % 9 = 0 THEN 'ready' ELSE status END AS status, failure_time_s AS f FROM episodes)
    SELECT episode_id, CASE WHEN f < 0 THEN 'range field=failure_time_s low=0'
                            WHEN f IS NOT NULL AND status <> 'failed' THEN 'failure_time_s needs status failed' END AS problem,
           CASE WHEN f >= 0 AND status = 'failed' THEN round(least(f, 60.0), 6) END AS value FROM t""",
)
def failure_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    eps = B.episodes(spark, sf_dir)
    status = F.when(F.col("episode_id") % 9 == 0, "ready").otherwise(F.col("status"))
    checked = catalog.checked_failure_time(status, F.col("failure_time_s"), F.col("duration_s"))
    return eps.select(
        "episode_id", checked["problem"].alias("problem"), F.round(checked["value"], 6).alias("value")
    )


@query(
    "eval_plan",
    f"""WITH {B.EPISODES_SQL}
    SELECT l_orderkey AS pos, l_linenumber, l_partkey, l_suppkey, baseline_episode_id, o_orderkey IS NOT NULL AS known FROM (
      SELECT *, (l_partkey * 10)::VARCHAR AS baseline_episode_id FROM lineitem WHERE l_linenumber <> 3 AND l_linenumber <> 4) x
    LEFT JOIN orders ON o_orderkey::VARCHAR = baseline_episode_id""",
)
def eval_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (F.col("l_partkey") * 10).cast("string")
    n = F.col("l_linenumber")
    token = F.when(n == 3, "  ").when(n == 4, F.concat(F.lit("#"), text)).otherwise(F.concat(F.lit(" "), text))
    asked = B.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pos"), "l_linenumber", "l_partkey", "l_suppkey", token.alias("token")
    )
    return catalog.eval_plan(asked, B.episodes(spark, sf_dir))


@query(
    "log_episodes",
    f"""WITH {B.EPISODES_SQL},
    t AS (SELECT *, episode_id % 11 = 0 AS broken, episode_id % 5 = 0 AS own,
                 CASE WHEN episode_id % 13 = 0 THEN 'a.mp4' ELSE 'a.npz' END AS file FROM episodes)
    SELECT episode_id, CASE WHEN own THEN 'sim' ELSE 'replay' END AS source,
           CASE WHEN broken OR file = 'a.mp4' THEN 'failed' ELSE status END AS status,
           CASE WHEN failure_time_s >= 0 THEN round(least(failure_time_s, 60.0), 6) END AS failure_time_s,
           CASE WHEN failure_time_s < 0 THEN 'range field=failure_time_s low=0' END AS problem,
           CASE WHEN broken THEN 'upload error: timed out' WHEN file = 'a.mp4' THEN 'upload error: file looks like video' END AS failure_reason
    FROM t""",
)
def log_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("episode_id")
    file = F.when(k % 13 == 0, "a.mp4").otherwise("a.npz")
    error = F.coalesce(
        F.when(k % 11 == 0, "timed out"), catalog.artifact_problem(file, F.lit("sensors"))
    )
    runs = B.episodes(spark, sf_dir).select(
        "episode_id", "status", "failure_time_s", "duration_s",
        F.when(k % 5 == 0, "sim").alias("source"), error.alias("upload_error"),
    )
    out = catalog.log_episodes(runs, model.DEFAULT_SOURCE["frames"])
    return out.drop("duration_s").withColumn("failure_time_s", F.round("failure_time_s", 6))


@query(
    "episode_table",
    f"""WITH {B.EPISODES_SQL}
    SELECT episode_id, CASE WHEN episode_id % 5 = 0 THEN 'sim' ELSE 'replay' END AS source,
           CASE WHEN episode_id % 11 = 0 AND episode_id % 4 <> 0 THEN 'failed' ELSE status END AS status,
           CASE WHEN failure_time_s >= 0 THEN round(least(failure_time_s, 60.0), 6) END AS failure_time_s,
           CASE WHEN episode_id % 11 = 0 AND episode_id % 4 <> 0 THEN 'upload error: timed out' END AS failure_reason,
           CASE WHEN episode_id % 4 = 0 THEN 'b-again' ELSE 'a-first' END AS "commit"
    FROM episodes""",
)
def episode_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs are logged to an episode table; a quarter is logged again without upload errors, after a try that fails."""
    k = F.col("episode_id")

    def logged(error) -> DataFrame:
        runs = B.episodes(spark, sf_dir).select(
            "episode_id", "status", "failure_time_s", "duration_s",
            F.when(k % 5 == 0, "sim").alias("source"), error.cast("string").alias("upload_error"),
        )
        return catalog.log_episodes(runs, model.DEFAULT_SOURCE["frames"]).drop("duration_s", "problem")

    root = staging.fresh(spark, "episodes")
    first = logged(F.when(k % 11 == 0, "timed out"))
    sink.write_episodes(first, root, "a-first")
    again = logged(F.lit(None)).where(k % 4 == 0)
    broken = F.when(k % 1000 == 4, F.raise_error(F.lit("broken on purpose"))).otherwise(F.col("source"))
    try:
        sink.write_episodes(again.withColumn("source", broken), root, "b-again")
    except PySparkException as e:
        if "broken on purpose" not in str(e):
            raise
    sink.write_episodes(again, root, "b-again")
    table = sink.read_episodes(spark, root, first.schema)
    return table.withColumn("failure_time_s", F.round("failure_time_s", 6))


@query(
    "finalize_episodes",
    """WITH c AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
    a AS (SELECT l_suppkey, sum(l_quantity)::BIGINT AS bytes FROM lineitem GROUP BY 1)
    SELECT o_custkey AS episode_id, CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'ready' END AS status,
           CASE WHEN o_orderstatus = 'F' THEN 'RuntimeError' || CASE WHEN o_orderkey % 2 = 0 THEN ': at ' || o_orderkey ELSE '' END END AS failure_reason,
           CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey WHEN o_orderkey % 3 = 1 THEN nullif(a.bytes, 0) END AS bytes_total
    FROM c LEFT JOIN a ON l_suppkey = o_custkey AND o_orderkey % 3 = 1 WHERE rn = 1""",
)
def finalize_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    failed = F.col("o_orderstatus") == "F"
    ended = catalog.exit_status(
        F.when(failed, "RuntimeError"),
        F.when(k % 2 == 0, F.concat(F.lit("at "), k.cast("string"))),
    )
    # Zero bytes count as unknown.
    explicit = F.when(k % 3 == 0, k).when(k % 3 == 2, 0)
    calls = B.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("episode_id"),
        ended["status"].alias("status"),
        ended["failure_reason"].alias("failure_reason"),
        explicit.cast("bigint").alias("bytes_total"),
        F.col("o_orderdate").alias("at"),
        k.alias("seq"),
    )
    artifacts = B.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("episode_id"), F.col("l_quantity").cast("bigint").alias("bytes_size")
    )
    return catalog.finalize(calls, artifacts, ["at", "seq"])


@query(
    "episode_lookup",
    """SELECT c_custkey * 20 AS episode_id, o_orderpriority AS policy_version, o_orderkey IS NOT NULL AS found
       FROM customer LEFT JOIN orders ON o_orderkey = c_custkey * 20""",
)
def episode_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = B.table(spark, sf_dir, "customer").select((F.col("c_custkey") * 20).alias("episode_id"))
    eps = B.episodes(spark, sf_dir).select("episode_id", "policy_version")
    return catalog.lookup(wanted, eps, "episode_id")


@query(
    "episode_subset",
    """SELECT c_custkey AS pos, c_custkey * 15 - 30 AS episode_id, o_orderpriority AS policy_version,
              CASE WHEN o_orderkey IS NULL THEN 'episode_index=' || (c_custkey * 15 - 30) || ' is out of range' END AS error
       FROM customer LEFT JOIN orders ON o_orderkey = c_custkey * 15 - 30""",
)
def episode_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = B.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pos"), (F.col("c_custkey") * 15 - 30).alias("episode_id")
    )
    eps = B.episodes(spark, sf_dir).select("episode_id", "policy_version")
    return catalog.subset(eps, "episode_id", wanted)


@query(
    "bulk_status",
    """WITH i AS (SELECT o_orderkey AS pos, CASE WHEN o_totalprice > 499000 THEN 'too dear' END AS error FROM orders),
    f AS (SELECT min(pos) AS p FROM i WHERE error IS NOT NULL)
    SELECT 'go on' AS mode, error IS NULL AS ok, count(*) AS n FROM i GROUP BY ALL
    UNION ALL SELECT 'stop', error IS NULL, count(*) FROM i, f WHERE p IS NULL OR pos <= p GROUP BY ALL""",
)
def bulk_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = B.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pos"), F.when(F.col("o_totalprice") > 499000, "too dear").alias("error")
    )
    n = F.count(F.lit(1)).alias("n")
    on = catalog.bulk_status(items, "error", "pos").groupBy(F.lit("go on").alias("mode"), "ok").agg(n)
    stop = catalog.bulk_status(items, "error", "pos", stop_on_error=True)
    return on.unionByName(stop.groupBy(F.lit("stop").alias("mode"), "ok").agg(n))
