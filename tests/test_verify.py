from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from runlens import model
from runlens.operators import verify

RESULT = (
    "eval_run_id STRING, status STRING, success_baseline BOOLEAN, success_candidate BOOLEAN, "
    "reward_total_baseline DOUBLE, reward_total_candidate DOUBLE, collision_count_baseline DOUBLE, "
    "collision_count_candidate DOUBLE, time_to_goal_s_baseline DOUBLE, time_to_goal_s_candidate DOUBLE, "
    "ood_action_share DOUBLE"
)


def rollup(spark, rows):
    return verify.run_rollup(spark.createDataFrame(rows, RESULT)).first()


def test_better_on_all_three_ships(spark):
    rows = [
        ("r", "complete", i == 0, True, 1.2, 9.2, 1.0 if i == 0 else 0.0, 0.0, None, None, None)
        for i in range(2)
    ]
    got = rollup(spark, rows)
    assert (got["better_count"], got["metric_total"], got["recommend"]) == (3, 3, "ship")
    assert got["metrics"][0]["delta"] == 0.5
    assert got["metrics"][2]["delta_is_better"] is True


def test_no_change_holds(spark):
    got = rollup(spark, [("r", "complete", True, True, None, None, None, None, None, None, 0.1)])
    assert (got["better_count"], got["metric_total"], got["recommend"]) == (0, 1, "hold")
    assert got["metrics"][0]["delta_is_better"] is False


def test_worse_success_never_ships(spark):
    got = rollup(spark, [("r", "complete", True, False, 1.0, 2.0, 1.0, 0.0, 9.0, 1.0, None)])
    assert (got["better_count"], got["metric_total"], got["recommend"]) == (3, 4, "hold")


def test_failed_rows_do_not_count(spark):
    rows = [
        ("r", "failed", None, None, None, None, None, None, None, None, None),
        ("r", "complete", False, True, 0.0, 0.0, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, RESULT)
    assert verify.run_rollup(df).first()["metrics"][0]["candidate"] == 1.0
    assert verify.run_counters(df).first()[1:] == (1, 1)


def test_report_lines(spark):
    df = spark.createDataFrame(
        [("r", "complete", False, True, 1.0, 0.5, None, None, None, None, None)], RESULT
    )
    lines = [r["line"] for r in verify.rollup_report(verify.run_rollup(df)).orderBy("line_no").collect()]
    assert lines[0].startswith("  ✓ success_rate") and lines[0].endswith("Δ=    +1.000")
    assert "✗ reward_mean" in lines[1] and lines[2].count("-") == 3
    assert lines[5] == "Recommend: hold  (1/2 metrics better)"


def scenarios(spark):
    return spark.createDataFrame(
        [("s1", "e1", "one", "critical"), ("s2", "e2", "two", "critical"), ("s3", "e3", "three", "warning")],
        "scenario_id STRING, baseline_episode_id STRING, name STRING, severity STRING",
    )


def results(spark, rows):
    return spark.createDataFrame(
        rows, "scenario_id STRING, candidate_policy_version STRING, status STRING, seq BIGINT"
    )


def test_latest_result_decides_and_missing_is_pending(spark):
    df = results(spark, [("s1", "v2", "fail", 1), ("s1", "v2", "pass", 2), ("s3", "v2", "fail", 1)])
    latest = verify.latest_status(df, ["seq"])
    row = verify.gate_of(scenarios(spark), latest, "v2").first().asDict()
    assert row == {
        "critical_total": 2, "critical_passed": 1, "critical_failed": 0, "critical_pending": 1, "passed": False,
    }
    assert verify.gate(scenarios(spark), latest).first().asDict() == {"candidate_policy_version": "v2", **row}
    assert [r["name"] for r in verify.blockers(scenarios(spark), latest, "v2").collect()] == ["two"]


def test_gate_without_critical_scenarios_passes(spark):
    none = scenarios(spark).where("severity = 'warning'")
    latest = verify.latest_status(results(spark, []), ["seq"])
    assert verify.gate_of(none, latest, "v9").first()["passed"] is True


@pytest.mark.parametrize("dry", [False, True])
def test_check_replays_what_is_pending(spark, dry):
    seen = []

    def evaluate(plan):
        seen.append(sorted(r["baseline_episode_id"] for r in plan.collect()))
        return plan.select(
            "baseline_episode_id", F.lit("complete").alias("status"), F.lit(True).alias("success_candidate")
        )

    verdict, fresh = verify.run_check(
        scenarios(spark), results(spark, [("s1", "v2", "pass", 1)]), ["seq"], "v2", evaluate, dry_run=dry
    )
    assert seen == [["e2"]]
    assert verdict.first()["exit_code"] == (1 if dry else 0)
    assert [r["verify_status"] for r in fresh.collect()] == ["pass"]


def test_scenarios_that_share_a_baseline_are_counted_once(spark):
    shared = spark.createDataFrame(
        [("s1", "e1", "one", "critical"), ("s2", "e1", "two", "critical")],
        "scenario_id STRING, baseline_episode_id STRING, name STRING, severity STRING",
    )

    def evaluate(plan):
        done = plan.select("baseline_episode_id", F.lit("complete").alias("status"), F.lit(True).alias("success_candidate"))
        return done.union(done)

    verdict, _ = verify.run_check(shared, results(spark, []), ["seq"], "v2", evaluate)
    row = verdict.first()
    # Results of a baseline belong to the last scenario listed for it.
    assert (row["critical_total"], row["critical_passed"], row["critical_failed"], row["critical_pending"]) == (2, 1, 0, 1)


def test_status_derivation(spark):
    rows = spark.createDataFrame(
        [("failed", True), ("complete", True), ("complete", False), ("complete", None)],
        "status STRING, ok BOOLEAN",
    )
    got = [r[0] for r in rows.select(verify.verification_status(F.col("status"), F.col("ok"))).collect()]
    assert got == ["error", "pass", "fail", "fail"]


def test_last_scenario_of_a_baseline_wins(spark):
    df = spark.createDataFrame(
        [("s1", "e", 1), ("s2", "e", 2)], "scenario_id STRING, baseline_episode_id STRING, pos INT"
    )
    assert verify.scenario_of_baseline(df, "pos").first()["scenario_id"] == "s2"


def test_promote_once_per_episode(spark):
    asked = spark.createDataFrame(
        [(1, "e1", None), (2, "e9", "critical"), (3, "e9", None)],
        "pos INT, baseline_episode_id STRING, severity STRING",
    )
    got = {r["pos"]: r for r in verify.promote(asked, scenarios(spark), "pos").collect()}
    assert (got[1]["scenario_id"], got[1]["promoted"], got[1]["severity"]) == ("s1", False, "warning")
    assert (got[2]["promoted"], got[2]["severity"]) == (True, "critical")
    assert got[3]["promoted"] is False and got[3]["scenario_id"] == got[2]["scenario_id"]


def test_declared_schemas_parse(spark):
    for ddl in (model.EPISODES, model.SAMPLES, model.EVAL_RESULTS, model.SCENARIOS, model.VERIFY_RESULTS):
        assert spark.createDataFrame([], ddl).count() == 0


def test_the_gate_names_blockers_of_all_candidates(spark):
    scenarios = spark.createDataFrame(
        [(1, "stairs", "critical"), (2, "door", "critical"), (3, "ramp", "warning"), (4, "door", "critical")],
        "scenario_id INT, name STRING, severity STRING",
    )
    latest = spark.createDataFrame(
        [(1, "v1", "pass"), (2, "v1", "fail"), (3, "v1", "fail"), (1, "v2", "pass"), (2, "v2", "pass"), (4, "v2", "pass"), (9, "v1", "pass")],
        "scenario_id INT, candidate_policy_version STRING, latest_status STRING",
    )
    candidates = spark.createDataFrame([("v1",), ("v2",), ("new",), ("v1",)], "candidate_policy_version STRING")
    body = verify.gate_body(scenarios, latest, candidates)
    got = {r["candidate_policy_version"]: r.asDict() for r in body.collect()}
    assert set(got) == {"v1", "v2", "new"}
    assert got["v1"]["blockers"] == ["door", "door"] and not got["v1"]["passed"]
    assert (got["v1"]["critical_failed"], got["v1"]["critical_pending"]) == (1, 1)
    assert got["v2"]["passed"] and got["v2"]["blockers"] == []
    assert got["new"]["blockers"] == got["new"]["scenarios"] == ["door", "door", "stairs"] and got["new"]["critical_pending"] == 3
    open_gate = verify.gate_body(scenarios.limit(0), latest, candidates).collect()
    assert all(r["passed"] and r["critical_total"] == 0 for r in open_gate)


def test_the_gate_of_many_scenarios_compares_no_two_of_them(spark):
    """Quadratic in the scenarios, this took 40,000 x 40,000 comparisons of records."""
    n = 40_000
    scenarios = spark.range(0, n).select(F.col("id").alias("scenario_id"), F.lpad(F.col("id").cast("string"), 6, "0").alias("name"), F.lit("critical").alias("severity"))
    latest = spark.range(0, n).select(F.col("id").alias("scenario_id"), F.lit("v").alias("candidate_policy_version"), F.when(F.col("id") % 3 == 0, "fail").otherwise("pass").alias("latest_status"))
    body = verify.gate_body(scenarios, latest, spark.sql("SELECT 'v' AS candidate_policy_version"))
    plan = body._jdf.queryExecution().optimizedPlan().toString()
    assert "array_except" in plan and "array<struct" not in plan.split("array_except")[1].split("AS blockers")[0]
    r = body.first()
    assert r["blockers"] == [f"{k:06d}" for k in range(0, n, 3)] and r["critical_total"] == len(r["scenarios"]) == n
