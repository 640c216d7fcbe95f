from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from runlens.operators import replay as rp

SERIES = "episode_id STRING, key STRING, step BIGINT, value ARRAY<DOUBLE>"


@pytest.fixture(scope="module")
def tables(spark):
    sensors, actions = [], []
    for ep, n in (("a", 6), ("b", 6), ("c", 6)):
        for i in range(n):
            sensors.append((ep, "/s/v", i, [float(i), 1.0]))
            actions.append((ep, "/cmd/v", i, [float(i)]))
    meta = [("a", '{"success":false,"reward_total":2}'), ("b", "{}"), ("c", '{"outcome":{"success":true}}')]
    metadata = spark.createDataFrame(meta, "episode_id STRING, m STRING").select(
        "episode_id", F.parse_json("m").alias("metadata")
    )
    plan = spark.createDataFrame(
        [(0, "a"), (1, "b"), (2, "c"), (3, "empty"), (4, "a")], "pos INT, baseline_episode_id STRING"
    )
    return (
        plan,
        spark.createDataFrame(sensors, SERIES),
        spark.createDataFrame(actions, SERIES),
        metadata,
    )


def by_pos(df):
    return {r["pos"]: r.asDict() for r in df.collect()}


def test_metrics_errors_and_mirrored_outcomes(tables):
    def policy(obs):
        x = obs["/s/v"]
        if x[0] == 3 and policy.broken:
            raise KeyError("boom")
        return {"/cmd/v": [x[0] + 1], "_outcome": {"success": True, "reward_total": None}}

    policy.broken = False
    got = by_pos(rp.evaluate(*tables, policy=policy, run_id="r1"))
    assert set(got) == {0, 1, 2, 3, 4}
    assert got[0]["status"] == "complete" and got[0]["action_l2_distance"] == 1.0
    assert (got[0]["success_baseline"], got[0]["success_candidate"]) == (False, True)
    # An explicit null beats the baseline value.
    assert (got[0]["reward_total_baseline"], got[0]["reward_total_candidate"]) == (2.0, None)
    assert got[0]["candidate_episode_id"] == "r1/a"
    # Nothing to observe: the policy never runs and the row is still complete.
    assert (got[3]["status"], got[3]["step_count"], got[3]["action_l2_distance"]) == ("complete", 0, None)
    assert {k: v for k, v in got[4].items() if k != "pos"} == {k: v for k, v in got[0].items() if k != "pos"}


def test_one_bad_step_fails_only_its_episode(spark, tables):
    plan, sensors, actions, metadata = tables
    marked = sensors.withColumn(
        "value", F.when((F.col("episode_id") == "b") & (F.col("step") >= 3), F.array(F.col("step") - 100.0)).otherwise(F.col("value"))
    )

    def policy(obs):
        if obs["/s/v"][0] < 0:
            raise RuntimeError(f"bad {obs['/s/v'][0]:.0f}")
        return {"/cmd/v": [obs["/s/v"][0]]}

    got = by_pos(rp.evaluate(plan, marked, actions, metadata, policy=policy, dry_run=True))
    assert (got[1]["status"], got[1]["error"]) == ("failed", "RuntimeError: bad -97")
    assert all(got[1][k] is None for k in ("step_count", "action_l2_distance", "success_baseline"))
    assert got[0]["status"] == got[2]["status"] == "complete"
    assert got[0]["candidate_episode_id"] is None
    assert got[2]["success_candidate"] is True


def test_answers_must_be_mappings(tables):
    got = by_pos(rp.evaluate(*tables, policy=lambda obs: [1, 2], dry_run=True))
    assert got[0]["error"] == "TypeError: a policy must return a mapping, got list"


def test_policies_with_state_see_steps_in_order(tables):
    _, sensors, _, _ = tables

    def factory():
        seen = []

        def policy(obs):
            seen.append(float(obs["/s/v"][0]))
            if len(seen) == 5 and seen[0] == 0:
                return {"n": len(seen), "ordered": float(seen == sorted(seen))}
            return {"n": len(seen), "ordered": float(seen == sorted(seen)), "none": None}

        return policy

    from runlens.operators.metrics import materialize_steps

    rows = rp.candidate_samples(rp.replay(materialize_steps(sensors), policy_factory=factory)).collect()
    assert {(r["step"], r["value"][0]) for r in rows if r["key"] == "n"} == {(i, i + 1.0) for i in range(6)}
    assert all(r["value"] == [1.0] for r in rows if r["key"] == "ordered")
    assert all(r["value"] is None for r in rows if r["key"] == "none")


def test_progress_can_be_observed(tables):
    df = rp.observed_progress(rp.evaluate(*tables, policy=lambda obs: {}, dry_run=True))
    df.collect()
    assert df.observation.get == {"episodes": 5, "completed": 5, "failed": 0}


def test_sentinel_kinds_and_text_keys(tables):
    import numpy as np

    def policy(obs):
        told = {"success": np.bool_(False), "time_to_goal_s": float("nan"), "collision_count": np.int64(2), "reward_total": "x"}
        return {"/cmd/v": np.asarray(obs["/s/v"][:1]), "note": "ok", "_outcome": told}

    got = by_pos(rp.evaluate(*tables, policy=policy, dry_run=True))
    row = got[0]
    assert row["status"] == "complete" and row["error"] is None
    assert row["success_candidate"] is False and row["collision_count_candidate"] == 2.0
    assert row["time_to_goal_s_candidate"] != row["time_to_goal_s_candidate"]
    assert row["reward_total_candidate"] is None


def test_repeated_keys_do_not_end_the_job(spark):
    from runlens.operators import metrics

    schema = "episode_id STRING, key STRING, step BIGINT, value ARRAY<DOUBLE>"
    base = spark.createDataFrame([("a", "/cmd/v", 0, [1.0]), ("a", "/cmd/v", 0, [3.0]), ("b", "/cmd/v", 0, [1.0])], schema)
    cand = spark.createDataFrame([("a", "/cmd/v", 0, [1.0]), ("b", "/cmd/v", 0, [1.0])], schema)
    assert {r["episode_id"]: r["action_l2"] for r in metrics.action_l2(base, cand).collect()} == {"a": 2.0, "b": 0.0}
    assert [tuple(r) for r in metrics.repeated_keys(base).collect()] == [("a", "/cmd/v", 0, 2)]


class Counting:
    """Answers with how often it was asked; breaks at the fifth step of episode b."""

    def __init__(self):
        self.seen = []

    def __call__(self, obs):
        self.seen.append(obs["/s/v"][0])
        if obs["/s/v"][1] == 9.0:
            raise KeyError("worn")
        return {"/cmd/v": [len(self.seen), sum(self.seen)]}


def observed(spark, rows):
    made = spark.createDataFrame(rows, "episode_id STRING, step BIGINT, x DOUBLE, y DOUBLE")
    return made.select("episode_id", "step", F.create_map(F.lit("/s/v"), F.array("x", "y")).alias("obs"))


def test_a_policy_that_remembers_goes_on_where_it_stopped(spark):
    rows = [(ep, i, float(i), 9.0 if ep == "b" and i == 4 else 1.0) for ep in ("a", "b", "c") for i in range(9)]
    whole, _ = rp.replay_resumed(observed(spark, rows), Counting)
    want = sorted(map(str, whole.collect()))
    first, states = rp.replay_resumed(observed(spark, [r for r in rows if r[1] < 3 and r[0] != "c"]), Counting)
    assert sorted(r.episode_id for r in states.collect()) == ["a", "b"]
    second, states = rp.replay_resumed(observed(spark, [r for r in rows if 3 <= r[1] < 6 or (r[0] == "c" and r[1] < 6)]), Counting, states)
    third, _ = rp.replay_resumed(observed(spark, [r for r in rows if r[1] >= 6]), Counting, states)
    assert sorted(map(str, first.union(second).union(third).collect())) == want
    by_step = {(r.episode_id, r.step): r for r in whole.collect()}
    assert by_step["a", 8].actions[0].value == [9.0, 36.0]
    assert by_step["b", 4].error == "KeyError: 'worn'" and by_step["b", 5].actions == [] and by_step["b", 5].error is None


def test_a_lost_task_begins_again_from_the_stored_states(spark, tmp_path):
    rows = [(ep, i, float(i), 1.0) for ep in ("a", "b") for i in range(6)]
    _, states = rp.replay_resumed(observed(spark, [r for r in rows if r[1] < 3]), Counting)
    mark = str(tmp_path / "lost")

    class Lost(Counting):
        def __call__(self, obs):
            import os

            if obs["/s/v"][0] == 4.0 and not os.path.exists(mark):
                open(mark, "w").close()
                os._exit(1)  # the worker is gone, and what the policy had seen in this try
            return super().__call__(obs)

    spark.sparkContext.setLogLevel("OFF")
    second = None
    for _ in range(2):  # local sessions do not try tasks again
        try:
            second, _ = rp.replay_resumed(observed(spark, [r for r in rows if r[1] >= 3]), Lost, None if second else states)
            break
        except Exception:  # noqa: BLE001
            continue
    spark.sparkContext.setLogLevel("ERROR")
    got = {(r.episode_id, r.step): r.actions[0].value for r in second.collect()}
    assert got["a", 5] == [6.0, 15.0] and got["b", 3] == [4.0, 6.0]


def test_callbacks_may_fail(tables):
    told = []

    def on_episode(row):
        told.append((row["pos"], row["baseline_episode_id"], row["status"]))
        raise RuntimeError("display")

    results = rp.evaluate(*tables, policy=lambda obs: {"/cmd/v": obs["/s/v"][:1]}, run_id="w", dry_run=True)
    stored, counters = rp.stored_with_progress(results, lambda c: 1 / 0, on_episode)
    assert counters == {"episodes": 5, "completed": 5, "failed": 0} and stored.count() == 5
    assert [t[1] for t in told] == ["a", "b", "c", "empty", "a"]
    assert {r["candidate_episode_id"] for r in stored.collect()} == {None}
