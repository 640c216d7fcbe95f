"""Queries on action distance, outcomes and replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.classify import is_metric_key
from runlens.functions.outcome import OUTCOME_KEYS, extract_outcome, mirror_outcome
from runlens.operators import catalog, metrics, verify
from runlens.operators.ordering import salted_join
from runlens.operators.outcomes import frame_outcomes
from runlens.operators.replay import candidate_samples, evaluate, replay, replay_resumed, replay_summary, stored_with_progress
from runlens.plans import bindings as B
from runlens.plans.registry import query
from runlens.session import materialize


@query(
    "action_l2",
    f"""WITH {B.line_sql()}
    SELECT episode_id, round(avg(sqrt(
             pow(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END, 2) + pow(l_tax * 2 - l_tax, 2) + 1)), 6) AS action_l2
    FROM steps GROUP BY episode_id""",
)
def action_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = B.line_steps(spark, sf_dir, keep=B.LINE_VALUES)
    out = metrics.action_l2(B.line_actions(steps), B.line_candidate(steps))
    return out.select("episode_id", F.round("action_l2", 6).alias("action_l2"))


# Candidate of the embedding episodes: every fifth vector is pushed far out,
# every seventh has another width, and label 9 sends an unmeasured key only.
def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vec = B.table(spark, sf_dir, "embeddings")
    base = vec.select(
        F.col("label").alias("episode_id"),
        F.lit("action/value").alias("key"),
        F.col("vec_id").alias("step"),
        F.col("embedding").alias("value"),
    )
    scale = F.when(F.col("vec_id") % 5 == 0, 4.0).otherwise(0.9)
    moved = F.transform("embedding", lambda x: x.cast("double") * scale)
    cand = vec.select(
        F.col("label").alias("episode_id"),
        F.when(F.col("label") == 9, "action").otherwise("action/value").alias("key"),
        F.col("vec_id").alias("step"),
        F.when(F.col("vec_id") % 7 == 0, F.slice(moved, 1, 3)).otherwise(moved).alias("value"),
    )
    return base, cand


@query(
    "ood_share",
    """WITH dims AS (
      SELECT label, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
    stats AS (
      SELECT label, dim, avg(x) AS m, stddev_pop(x) AS s, count(*) AS n FROM dims GROUP BY ALL HAVING count(*) >= 5),
    z AS (
      SELECT d.label, d.vec_id,
             max(CASE WHEN d.vec_id % 7 = 0 THEN 0 ELSE abs(
               (d.x * CASE WHEN d.vec_id % 5 = 0 THEN 4.0 ELSE 0.9 END::DOUBLE - m) / CASE WHEN s < 1e-9 THEN 1 ELSE s END) END) AS z
      FROM dims d JOIN stats USING (label, dim) WHERE d.label <> 9 GROUP BY ALL)
    SELECT l.label AS episode_id, round(s.share, 6) AS ood_share
    FROM (SELECT DISTINCT label FROM embeddings) l
    LEFT JOIN (SELECT label, avg((z > 3.0)::INT) AS share FROM z GROUP BY label) s USING (label)""",
)
def ood_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.ood_share(*_vectors(spark, sf_dir))
    return out.select("episode_id", F.round("ood_share", 6).alias("ood_share"))


@query(
    "materialize_steps",
    f"""WITH {B.TALK_SQL},
    n AS (SELECT episode_id, min(c) AS n FROM (SELECT episode_id, key, count(*) AS c FROM sensors GROUP BY ALL) GROUP BY 1)
    SELECT episode_id, step, count(*) AS n_keys,
           string_agg(key || '=' || x::BIGINT, ';' ORDER BY key) AS obs
    FROM sensors JOIN n USING (episode_id) WHERE step < n GROUP BY ALL""",
)
def materialize_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = metrics.materialize_steps(B.talk_sensors(spark, sf_dir))
    pairs = F.transform(
        F.map_entries("obs"),
        lambda e: F.concat(e["key"], F.lit("="), e["value"][0].cast("bigint").cast("string")),
    )
    return steps.select(
        "episode_id",
        "step",
        F.size("obs").cast("bigint").alias("n_keys"),
        F.array_join(F.sort_array(pairs), ";").alias("obs"),
    )


# ── outcomes ─────────────────────────────────────────────────────────


@query(
    "outcome_extract",
    f"WITH {B.OUTCOME_SQL} SELECT doc_id, success, reward_total, collision_count, NULL::DOUBLE AS time_to_goal_s FROM outcomes",
)
def outcome_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = B.outcome_metadata(spark, sf_dir)
    return meta.select("doc_id", extract_outcome(F.col("metadata")).alias("o")).select("doc_id", "o.*")


def _mirrored(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = B.outcome_metadata(spark, sf_dir).withColumn("b", extract_outcome(F.col("metadata")))
    both = meta.withColumn("c", mirror_outcome(F.col("sentinel"), F.col("b")))
    cols = []
    for key in OUTCOME_KEYS:
        cols += [F.col(f"b.{key}").alias(f"{key}_baseline"), F.col(f"c.{key}").alias(f"{key}_candidate")]
    return both.select("doc_id", *cols)


@query(
    "outcome_mirror",
    f"""WITH {B.OUTCOME_SQL}
    SELECT doc_id, success_baseline, success_candidate, reward_baseline AS reward_total_baseline,
           reward_candidate AS reward_total_candidate, collision_baseline AS collision_count_baseline,
           collision_candidate AS collision_count_candidate, NULL::DOUBLE AS time_to_goal_s_baseline,
           NULL::DOUBLE AS time_to_goal_s_candidate FROM mirrored""",
)
def outcome_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mirrored(spark, sf_dir)


@query(
    "outcome_lerobot",
    f"""WITH {B.line_sql()}
    SELECT episode_id, arg_max(l_extendedprice, step) AS next_reward, true AS next_done,
           round(sum(l_extendedprice), 4) AS next_reward_sum
    FROM steps GROUP BY episode_id""",
)
def outcome_lerobot(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ends are marked while steps are numbered: no join sorts all steps once more.
    steps = B.line_steps(spark, sf_dir, keep=["l_extendedprice"], last="done")
    frames = steps.select(
        "episode_id",
        F.col("step").alias("frame_index"),
        F.col("l_extendedprice").alias("next.reward"),
        F.col("done").alias("next.done"),
    )
    out = frame_outcomes(frames, ["next.reward", "next.done"], "episode_id", "frame_index")
    return out.select(
        "episode_id",
        F.col("outcome")["next.reward"].alias("next_reward"),
        F.col("outcome")["next.done"].alias("next_done"),
        F.round("reward_sum", 4).alias("next_reward_sum"),
    )


@query(
    "numeric_keys",
    """WITH keys(i, key, dtype) AS (VALUES (0,'/cmd_vel/linear','float32'),(1,'/cmd_vel/_t_ns','int64'),
      (2,'action','float32'),(3,'/gripper/open','bool'),(4,'/meta/labels','object'),(5,'/arm/index','int64'),
      (6,'/xt_ns','float64'),(7,'/name','<U8'))
    SELECT key, dtype, key IN ('/cmd_vel/linear','/arm/index','/xt_ns') AS used, count(*) AS n
    FROM events e JOIN keys k ON e.event_id % 8 = k.i GROUP BY ALL""",
)
def numeric_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = (
        "(0,'/cmd_vel/linear','float32'),(1,'/cmd_vel/_t_ns','int64'),(2,'action','float32'),"
        "(3,'/gripper/open','bool'),(4,'/meta/labels','object'),(5,'/arm/index','int64'),"
        "(6,'/xt_ns','float64'),(7,'/name','<U8')"
    )
    ev = B.cases(spark, sf_dir, values, "key, dtype", 8)
    used = is_metric_key(F.col("key"), F.col("dtype"))
    return ev.withColumn("used", used).groupBy("key", "dtype", "used").agg(F.count(F.lit(1)).alias("n"))


# ── replay of a Python policy over line items ────────────────────────


def line_policy(obs):
    """Echoes the recorded action with a few changes; breaks on one reading."""
    q, d, t, returned = obs["/state/value"]
    if q >= 50 and d >= 0.1 and t >= 0.08:
        raise ValueError("saturated")
    return {
        "/cmd_vel/linear": [q + returned, d, t * 2],
        "/grip": obs["/state/price"] + 1,
        "_outcome": {"success": bool(q > 20)},
    }


def _line_sensors(steps: DataFrame) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    return steps.select(
        "episode_id",
        "step",
        F.inline(
            F.array(
                F.struct(
                    F.lit("/state/value").alias("key"),
                    F.array("l_quantity", "l_discount", "l_tax", returned).alias("value"),
                ),
                F.struct(F.lit("/state/price").alias("key"), F.array("l_extendedprice").alias("value")),
            )
        ),
    )


_BROKEN_SQL = """broken AS (
  SELECT DISTINCT episode_id FROM steps WHERE l_quantity >= 50 AND l_discount >= 0.1 AND l_tax >= 0.08)"""


@query(
    "replay_policy",
    f"""WITH {B.line_sql()}, {_BROKEN_SQL},
    answered AS (SELECT * FROM steps WHERE NOT (l_quantity >= 50 AND l_discount >= 0.1 AND l_tax >= 0.08))
    SELECT a.episode_id, key, count(*) AS n,
           round(sum(CASE WHEN key = '/grip' THEN l_extendedprice + 1
                          ELSE l_quantity + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END END), 4) AS total,
           CASE WHEN b.episode_id IS NOT NULL THEN 'ValueError: saturated' END AS error
    FROM answered a CROSS JOIN (VALUES ('/cmd_vel/linear'), ('/grip')) k(key)
    LEFT JOIN broken b ON b.episode_id = a.episode_id
    GROUP BY ALL""",
)
def replay_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = metrics.materialize_steps(_line_sensors(_stored_steps(spark, sf_dir)))
    played = materialize(replay(observed, line_policy), "replay-policy")
    errors = replay_summary(played).select("episode_id", "error")
    totals = (
        candidate_samples(played)
        .groupBy("episode_id", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value")[0]), 4).alias("total"))
    )
    return totals.join(errors, "episode_id")


def _stored_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered line items, the way recordings are kept: numbering stores them."""
    return B.line_steps(spark, sf_dir, keep=B.LINE_VALUES)


def _line_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = B.outcome_metadata(spark, sf_dir)
    sup = B.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("episode_id"))
    return sup.join(meta, F.col("episode_id") == F.col("doc_id"), "left").select("episode_id", "metadata")


def _supplier_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("pos"), F.col("s_suppkey").alias("baseline_episode_id")
    )


_REPLAY_SQL = f"""{B.line_sql()}, {_BROKEN_SQL}, {B.OUTCOME_SQL},
  stats AS (
    SELECT episode_id, count(*) AS n, avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs,
           avg(l_discount) AS dm, stddev_pop(l_discount) AS ds, avg(l_tax) AS tm, stddev_pop(l_tax) AS ts
    FROM steps GROUP BY 1),
  scored AS (
    SELECT s.episode_id, s.step,
           sqrt(pow(r, 2) + pow(l_tax, 2) + 1) AS d, l_quantity > 20 AS told,
           CASE WHEN n >= 5 THEN greatest(abs((l_quantity + r - qm) / CASE WHEN qs < 1e-9 THEN 1 ELSE qs END),
                    abs((l_discount - dm) / CASE WHEN ds < 1e-9 THEN 1 ELSE ds END),
                    abs((l_tax * 2 - tm) / CASE WHEN ts < 1e-9 THEN 1 ELSE ts END)) > 3.0 END AS ood
    FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS r FROM steps) s JOIN stats USING (episode_id)),
  replayed AS (
    SELECT s_suppkey AS episode_id, b.episode_id IS NOT NULL AS broken, count(step) AS step_count, avg(d) AS l2,
           avg(ood::INT) AS ood, arg_max(told, step) AS told
    FROM supplier LEFT JOIN scored ON s_suppkey = scored.episode_id
    LEFT JOIN broken b ON b.episode_id = s_suppkey GROUP BY 1, 2),
  results AS (
    SELECT r.episode_id, CASE WHEN broken THEN 'failed' ELSE 'complete' END AS status,
           CASE WHEN broken THEN 'ValueError: saturated' END AS error,
           CASE WHEN NOT broken THEN o.success END AS success_baseline,
           CASE WHEN NOT broken THEN CASE WHEN step_count > 0 THEN told ELSE o.success END END AS success_candidate,
           CASE WHEN NOT broken THEN o.reward_total END AS reward_total_candidate,
           CASE WHEN NOT broken THEN round(l2, 6) END AS action_l2_distance,
           CASE WHEN NOT broken THEN round(ood, 6) END AS ood_action_share,
           CASE WHEN NOT broken THEN step_count END AS step_count
    FROM replayed r LEFT JOIN outcomes o ON o.doc_id = r.episode_id)"""


@query("replay_metrics", f"WITH {_REPLAY_SQL} SELECT * FROM results")
def replay_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _stored_steps(spark, sf_dir)
    out = evaluate(
        _supplier_plan(spark, sf_dir),
        _line_sensors(steps),
        B.line_actions(steps),
        _line_metadata(spark, sf_dir),
        policy=line_policy,
        run_id="lines",
    )
    return out.select(
        F.col("baseline_episode_id").alias("episode_id"),
        "status",
        "error",
        "success_baseline",
        "success_candidate",
        "reward_total_candidate",
        F.round("action_l2_distance", 6).alias("action_l2_distance"),
        F.round("ood_action_share", 6).alias("ood_action_share"),
        "step_count",
    )


class CarefulPolicy:
    """Remembers what it lifted: answers with the running total, and breaks for good beyond a limit."""

    LIMIT = 20_000

    def __init__(self):
        self.total, self.lifts = 0.0, 0

    def __call__(self, obs):
        quantity, _, _, returned = obs["/state/value"]
        self.lifts += 1
        self.total += quantity * (2 if returned else 1)
        if self.total > self.LIMIT:
            raise RuntimeError(f"worn out after {self.lifts}")
        return {"/lift": [self.total, self.lifts]}


_REMEMBERED_SQL = f"""{B.line_sql()},
    worked AS (
      SELECT episode_id, step, sum(l_quantity * CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END) OVER w AS total
      FROM steps WINDOW w AS (PARTITION BY episode_id ORDER BY step)),
    ended AS (SELECT episode_id, min(step) FILTER (total > 20000) AS broke, count(*) AS steps FROM worked GROUP BY 1)"""


@query(
    "replay_resumed",
    f"""WITH {_REMEMBERED_SQL}
    SELECT w.episode_id, any_value(steps) AS steps, count(*) FILTER (broke IS NULL OR step < broke) AS answered,
           max(total) FILTER (broke IS NULL OR step < broke) AS lifted,
           sum(step + 1) FILTER (broke IS NULL OR step < broke)::DOUBLE AS lifts,
           CASE WHEN any_value(broke) IS NOT NULL THEN 'RuntimeError: worn out after ' || any_value(broke) + 1 END AS error
    FROM worked w JOIN ended USING (episode_id) GROUP BY 1""",
)
def replay_resumed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy that remembers is replayed over the first 200 steps of each episode and resumed for the rest."""
    observed = metrics.materialize_steps(_line_sensors(_stored_steps(spark, sf_dir)))
    first, states = replay_resumed(observed.where(F.col("step") < 200), CarefulPolicy)
    second, _ = replay_resumed(observed.where(F.col("step") >= 200), CarefulPolicy, states)
    played = first.unionByName(second)
    lift = F.try_element_at(F.transform("actions", lambda a: a["value"]), F.lit(1))
    return played.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("steps"), F.count_if(F.size("actions") > 0).alias("answered"), F.max(lift[0]).alias("lifted"),
        F.sum(lift[1]).alias("lifts"), F.max("error").alias("error"),
    )


@query(
    "replay_progress",
    f"""WITH {_REPLAY_SQL}
    SELECT 'counted while written' AS source, count(*) AS episodes, count(*) FILTER (status = 'complete') AS completed,
           count(*) FILTER (status = 'failed') AS failed FROM results
    UNION ALL SELECT 'told one by one', count(*), count(*) FILTER (status = 'complete'), count(*) FILTER (status = 'failed') FROM results""",
)
def replay_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of an evaluation, and what a callback that fails now and then was told."""
    steps = _stored_steps(spark, sf_dir)
    results = evaluate(
        _supplier_plan(spark, sf_dir), _line_sensors(steps), B.line_actions(steps), _line_metadata(spark, sf_dir),
        policy=line_policy, run_id="watched", dry_run=True,
    )
    told = {"episodes": 0, "completed": 0, "failed": 0}

    def on_episode(row):
        told["episodes"] += 1
        told["completed"] += row["status"] == "complete"
        told["failed"] += row["status"] == "failed"
        if told["episodes"] % 2:
            raise RuntimeError("the display is gone")

    def on_progress(counters):
        raise RuntimeError(f"no display for {counters}")

    _, counters = stored_with_progress(results, on_progress, on_episode)
    rows = [(name, *(int(c[k]) for k in told)) for name, c in (("counted while written", counters), ("told one by one", told))]
    return spark.createDataFrame(rows, "source STRING, episodes BIGINT, completed BIGINT, failed BIGINT")


# ── rollups and gates ────────────────────────────────────────────────


def _label_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mirrored(spark, sf_dir).select(
        (F.col("doc_id") % 5).alias("eval_run_id"),
        F.col("doc_id").alias("baseline_episode_id"),
        F.when(F.col("doc_id") % 11 == 0, "failed").otherwise("complete").alias("status"),
        F.col("success_baseline"),
        F.col("success_candidate"),
        F.col("reward_total_baseline"),
        F.col("reward_total_candidate"),
        F.col("collision_count_baseline"),
        F.lit(0.0).alias("collision_count_candidate"),
        F.col("time_to_goal_s_baseline"),
        F.col("time_to_goal_s_candidate"),
        (F.col("doc_id") % 3 / 10).alias("ood_action_share"),
    )


_ROLLUP_SQL = f"""{B.OUTCOME_SQL},
  sides AS (
    SELECT doc_id % 5 AS eval_run_id,
           avg(success_baseline::INT) AS sb, avg(success_candidate::INT) AS sc,
           avg(reward_baseline) AS rb, avg(reward_candidate) AS rc,
           avg((collision_baseline > 0)::INT) AS cb, 0.0::DOUBLE AS cc, avg((doc_id % 3) / 10.0::DOUBLE) AS oc
    FROM mirrored WHERE doc_id % 11 <> 0 GROUP BY 1),
  lines AS (
    SELECT eval_run_id, 'success_rate' AS metric, sb AS b, sc AS c, sc > sb AS better, 0 AS i FROM sides UNION ALL
    SELECT eval_run_id, 'reward_mean', rb, rc, rc > rb, 1 FROM sides UNION ALL
    SELECT eval_run_id, 'collision_rate', cb, cc, cc < cb, 2 FROM sides UNION ALL
    SELECT eval_run_id, 'time_to_goal_s', NULL, NULL, NULL, 3 FROM sides UNION ALL
    SELECT eval_run_id, 'ood_action_share', NULL, oc, NULL, 4 FROM sides),
  verdicts AS (
    SELECT eval_run_id, count(*) FILTER (better) AS better_count, count(c - b) AS metric_total,
           CASE WHEN 2 * count(*) FILTER (better) > count(c - b)
                 AND NOT bool_or(i = 0 AND coalesce(c < b, false)) THEN 'ship' ELSE 'hold' END AS recommend
    FROM lines GROUP BY 1)"""


@query(
    "run_rollup",
    f"""WITH {_ROLLUP_SQL}
    SELECT eval_run_id, metric, round(b, 6) AS baseline, round(c, 6) AS candidate, round(c - b, 6) AS delta,
           better AS delta_is_better, better_count, metric_total, recommend
    FROM lines JOIN verdicts USING (eval_run_id)""",
)
def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = verify.run_rollup(_label_results(spark, sf_dir))
    flat = rolled.select("eval_run_id", F.inline("metrics"), "better_count", "metric_total", "recommend")
    for name in ("baseline", "candidate", "delta"):
        flat = flat.withColumn(name, F.round(name, 6))
    return flat


_TEXT_SQL = "CASE WHEN {0} IS NULL THEN '-' ELSE format('{{:.3f}}', {0}) END"


@query(
    "report_summary",
    f"""WITH {_ROLLUP_SQL}
    SELECT eval_run_id, i AS line_no,
           '  ' || CASE WHEN better IS NULL THEN ' ' WHEN better THEN '✓' ELSE '✗' END || ' ' || rpad(metric, 20, ' ')
           || ' baseline=' || lpad({_TEXT_SQL.format('b')}, 10, ' ')
           || '  candidate=' || lpad({_TEXT_SQL.format('c')}, 10, ' ')
           || '  Δ=' || lpad(CASE WHEN c - b IS NULL THEN '-' ELSE CASE WHEN c - b >= 0 THEN '+' ELSE '' END
                             || format('{{:.3f}}', c - b) END, 10, ' ') AS line
    FROM lines
    UNION ALL SELECT eval_run_id, 5, 'Recommend: ' || recommend || '  (' || better_count || '/' || metric_total || ' metrics better)'
    FROM verdicts""",
)
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.rollup_report(verify.run_rollup(_label_results(spark, sf_dir)))


@query(
    "run_counters",
    """SELECT doc_id % 5 AS eval_run_id, count(*) FILTER (doc_id % 11 <> 0) AS episodes_completed,
              count(*) FILTER (doc_id % 11 = 0) AS episodes_failed FROM labels GROUP BY 1""",
)
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.run_counters(_label_results(spark, sf_dir))


@query(
    "verify_status",
    f"""WITH {B.OUTCOME_SQL},
    scenario AS (SELECT o_custkey AS baseline_episode_id, max(o_orderkey) AS scenario_id FROM orders GROUP BY 1)
    SELECT scenario_id, doc_id AS baseline_episode_id,
           CASE WHEN doc_id % 11 = 0 THEN 'error' WHEN success_candidate THEN 'pass' ELSE 'fail' END AS verify_status
    FROM mirrored JOIN scenario ON baseline_episode_id = doc_id""",
)
def verify_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    scenarios = B.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scenario_id"),
        F.col("o_custkey").alias("baseline_episode_id"),
        F.col("o_orderkey").alias("pos"),
    )
    out = verify.scenario_results(_label_results(spark, sf_dir), scenarios, "pos")
    return out.select("scenario_id", "baseline_episode_id", "verify_status")


_RESULT_ORDER = ("l_shipdate", *[c for c in B.LINE_ORDER if c != "l_shipdate"])


def _verify_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("l_quantity") < 25, "pass").when(F.col("l_quantity") < 45, "fail").otherwise("error")
    return B.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("scenario_id"),
        F.col("l_returnflag").alias("candidate_policy_version"),
        status.alias("status"),
        *_RESULT_ORDER,
    )


def _supplier_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("scenario_id"),
        F.col("s_suppkey").alias("baseline_episode_id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") % 2 == 0, "critical").otherwise("warning").alias("severity"),
    )


_LATEST_SQL = f"""latest AS (
  SELECT l_suppkey AS scenario_id, l_returnflag AS candidate_policy_version,
         CASE WHEN l_quantity < 25 THEN 'pass' WHEN l_quantity < 45 THEN 'fail' ELSE 'error' END AS latest_status
  FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag
          ORDER BY {", ".join(c + " DESC" for c in _RESULT_ORDER)}) AS rn FROM lineitem) WHERE rn = 1),
scenarios AS (
  SELECT s_suppkey AS scenario_id, s_suppkey AS baseline_episode_id, s_name AS name,
         CASE WHEN s_nationkey % 2 = 0 THEN 'critical' ELSE 'warning' END AS severity FROM supplier)"""


@query("latest_status", f"WITH {_LATEST_SQL} SELECT * FROM latest")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.latest_status(_verify_rows(spark, sf_dir), _RESULT_ORDER)


@query(
    "pending_critical",
    f"""WITH {_LATEST_SQL}
    SELECT s.scenario_id, s.name, l.latest_status FROM scenarios s
    LEFT JOIN latest l ON l.scenario_id = s.scenario_id AND candidate_policy_version = 'N'
    WHERE severity = 'critical' AND latest_status IS DISTINCT FROM 'pass'""",
)
def pending_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = verify.latest_status(_verify_rows(spark, sf_dir), _RESULT_ORDER)
    out = verify.blockers(_supplier_scenarios(spark, sf_dir), latest, "N")
    return out.select("scenario_id", "name", "latest_status")


@query(
    "gate",
    f"""WITH {_LATEST_SQL}, total AS (SELECT count(*) AS n FROM scenarios WHERE severity = 'critical')
    SELECT candidate_policy_version, (SELECT n FROM total) AS critical_total,
           count(*) FILTER (severity = 'critical' AND latest_status = 'pass') AS critical_passed,
           count(*) FILTER (severity = 'critical' AND latest_status <> 'pass') AS critical_failed,
           (SELECT n FROM total) - count(*) FILTER (severity = 'critical') AS critical_pending,
           count(*) FILTER (severity = 'critical' AND latest_status = 'pass') = (SELECT n FROM total) AS passed
    FROM latest LEFT JOIN scenarios USING (scenario_id) GROUP BY 1""",
)
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = verify.latest_status(_verify_rows(spark, sf_dir), _RESULT_ORDER)
    return verify.gate(_supplier_scenarios(spark, sf_dir), latest)


@query(
    "gate_body",
    f"""WITH {_LATEST_SQL},
    candidates AS (SELECT l_returnflag AS v FROM lineitem UNION SELECT l_linestatus FROM lineitem),
    critical AS (SELECT scenario_id, name FROM scenarios WHERE severity = 'critical'),
    known AS (
      SELECT v, c.scenario_id, c.name, l.latest_status FROM candidates CROSS JOIN critical c
      LEFT JOIN latest l ON l.scenario_id = c.scenario_id AND l.candidate_policy_version = v)
    SELECT v AS candidate_policy_version, count(*) AS critical_total,
           count(*) FILTER (latest_status = 'pass') AS critical_passed,
           count(*) FILTER (latest_status <> 'pass') AS critical_failed,
           count(*) FILTER (latest_status IS NULL) AS critical_pending,
           count(*) FILTER (latest_status = 'pass') = count(*) AS passed,
           coalesce(string_agg(name, ',' ORDER BY name, scenario_id), '') AS scenarios,
           coalesce(string_agg(name, ',' ORDER BY name, scenario_id) FILTER (latest_status IS DISTINCT FROM 'pass'), '') AS blockers
    FROM known GROUP BY v""",
)
def gate_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line statuses are candidates that have no results at all."""
    lines = B.table(spark, sf_dir, "lineitem")
    candidates = lines.select(F.explode(F.array("l_returnflag", "l_linestatus")).alias("candidate_policy_version")).distinct()
    latest = verify.latest_status(_verify_rows(spark, sf_dir), _RESULT_ORDER)
    body = verify.gate_body(_supplier_scenarios(spark, sf_dir), latest, candidates)
    return body.withColumns({c: F.array_join(c, ",") for c in ("scenarios", "blockers")})


@query(
    "record_results",
    """SELECT status, error IS NOT NULL AS has_error, success, n,
       coalesce(status, CASE WHEN error IS NOT NULL THEN 'error' WHEN success THEN 'pass' ELSE 'fail' END) AS recorded
    FROM (SELECT CASE WHEN l_linenumber = 1 THEN 'pass' WHEN l_linenumber = 2 THEN 'fail' END AS status,
                 CASE WHEN l_quantity >= 45 THEN 'stuck' END AS error,
                 CASE WHEN l_tax > 0.05 THEN true WHEN l_tax > 0.01 THEN false END AS success, count(*) AS n
          FROM lineitem GROUP BY ALL)""",
)
def record_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, tax = F.col("l_linenumber"), F.col("l_tax")
    given = B.table(spark, sf_dir, "lineitem").select(
        F.when(line == 1, "pass").when(line == 2, "fail").alias("status"),
        F.when(F.col("l_quantity") >= 45, "stuck").alias("error"),
        F.when(tax > 0.05, True).when(tax > 0.01, False).alias("success_candidate"),
    )
    recorded = verify.record_results(given.withColumn("said", F.col("status")))
    return recorded.groupBy(
        F.col("said").alias("status"), F.col("error").isNotNull().alias("has_error"),
        F.col("success_candidate").alias("success"), F.col("status").alias("recorded"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "run_check",
    f"""WITH {_REPLAY_SQL}, {_LATEST_SQL},
    before AS (
      SELECT s.scenario_id, severity, latest_status FROM scenarios s
      LEFT JOIN latest l ON l.scenario_id = s.scenario_id AND candidate_policy_version = 'N'),
    after AS (
      SELECT b.scenario_id, severity,
             CASE WHEN severity = 'critical' AND latest_status IS DISTINCT FROM 'pass' THEN
               CASE WHEN status = 'failed' THEN 'error' WHEN success_candidate THEN 'pass' ELSE 'fail' END
             ELSE latest_status END AS latest_status
      FROM before b JOIN results r ON r.episode_id = b.scenario_id)
    SELECT count(*) FILTER (severity = 'critical') AS critical_total,
           count(*) FILTER (severity = 'critical' AND latest_status = 'pass') AS critical_passed,
           count(*) FILTER (severity = 'critical' AND latest_status <> 'pass') AS critical_failed,
           count(*) FILTER (severity = 'critical' AND latest_status IS NULL) AS critical_pending,
           count(*) FILTER (severity = 'critical' AND latest_status = 'pass') = count(*) FILTER (severity = 'critical') AS passed,
           CASE WHEN count(*) FILTER (severity = 'critical' AND latest_status = 'pass') = count(*) FILTER (severity = 'critical')
                THEN 0 ELSE 1 END AS exit_code
    FROM after""",
)
def run_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _stored_steps(spark, sf_dir)

    def replayed(plan: DataFrame) -> DataFrame:
        return evaluate(
            plan,
            _line_sensors(steps),
            B.line_actions(steps),
            _line_metadata(spark, sf_dir),
            policy=line_policy,
            run_id="check",
        )

    verdict, _ = verify.run_check(
        _supplier_scenarios(spark, sf_dir),
        _verify_rows(spark, sf_dir),
        _RESULT_ORDER,
        "N",
        replayed,
    )
    return verdict


@query(
    "promote_scenarios",
    """WITH first AS (SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY 1)
    SELECT o_orderkey AS pos, o_custkey AS baseline_episode_id,
           CASE WHEN s_suppkey IS NOT NULL THEN s_suppkey::VARCHAR ELSE 'scenario-' || o_custkey END AS scenario_id,
           'warning' AS severity, s_suppkey IS NULL AND o_orderkey = first AS promoted
    FROM orders JOIN first USING (o_custkey) LEFT JOIN supplier ON s_suppkey = o_custkey""",
)
def promote_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = B.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("baseline_episode_id")
    )
    existing = _supplier_scenarios(spark, sf_dir).withColumn(
        "scenario_id", F.col("scenario_id").cast("string")
    )
    return verify.promote(requests, existing, "pos")


@query(
    "result_upsert",
    f"""SELECT l_returnflag AS eval_run_id, l_suppkey AS baseline_episode_id,
           l_linestatus AS status, l_extendedprice AS reward
    FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_suppkey
            ORDER BY {", ".join(c + " DESC" for c in B.LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
)
def result_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [c for c in B.LINE_ORDER if c not in ("l_returnflag", "l_suppkey")]
    rows = B.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("eval_run_id"),
        F.col("l_suppkey").alias("baseline_episode_id"),
        F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("reward"),
        *order,
    )
    return catalog.upsert(rows, ["eval_run_id", "baseline_episode_id"], order)


@query(
    "mirror_results",
    f"""WITH {B.OUTCOME_SQL},
    scenario AS (SELECT o_custkey AS baseline_episode_id, max(o_orderkey) AS scenario_id FROM orders GROUP BY 1)
    SELECT scenario_id, 'next' AS candidate_policy_version, doc_id AS baseline_episode_id, doc_id % 5 AS eval_run_id,
           CASE WHEN doc_id % 11 = 0 THEN 'error' WHEN success_candidate THEN 'pass' ELSE 'fail' END AS status
    FROM mirrored JOIN scenario ON baseline_episode_id = doc_id""",
)
def mirror_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    scenarios = B.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scenario_id"),
        F.col("o_custkey").alias("baseline_episode_id"),
        F.col("o_orderkey").alias("pos"),
    )
    return verify.mirror_results(_label_results(spark, sf_dir), scenarios, "pos", "next")
