"""Declared schemas of the fixed tables, as DDL."""

from __future__ import annotations

SLOTS = ("video", "sensors", "actions")

EPISODES = """episode_id STRING, name STRING, source STRING, robot STRING, policy_version STRING,
    env_version STRING, git_sha STRING, seed BIGINT, fps DOUBLE, duration_s DOUBLE, status STRING,
    failure_time_s DOUBLE, bytes_total BIGINT, metadata VARIANT,
    otel STRUCT<trace_id: STRING, span_id: STRING, traceparent: STRING>"""

SAMPLES = """episode_id STRING, slot STRING, key STRING, ns STRING, field STRING, step BIGINT,
    t_ns BIGINT, value ARRAY<FLOAT>, shape ARRAY<INT>"""

MESSAGES = "recording_id STRING, topic STRING, msgtype STRING, t_ns BIGINT, seq BIGINT, payload VARIANT"

ISSUES = "recording_id STRING, slot STRING, item STRING, reason STRING"

METRICS = """success_baseline BOOLEAN, success_candidate BOOLEAN, reward_total_baseline DOUBLE,
    reward_total_candidate DOUBLE, collision_count_baseline DOUBLE, collision_count_candidate DOUBLE,
    time_to_goal_s_baseline DOUBLE, time_to_goal_s_candidate DOUBLE, action_l2_distance DOUBLE,
    ood_action_share DOUBLE, step_count BIGINT"""

EVAL_RESULTS = f"""eval_run_id STRING, baseline_episode_id STRING, candidate_episode_id STRING,
    status STRING, error STRING, {METRICS}"""

SCENARIOS = """scenario_id STRING, baseline_episode_id STRING, name STRING, description STRING,
    severity STRING"""

VERIFY_RESULTS = """scenario_id STRING, candidate_policy_version STRING, status STRING,
    candidate_episode_id STRING, eval_run_id STRING, metrics STRING, error STRING, seq BIGINT"""

H5_DATASETS = """path STRING, demo STRING, name STRING, kind STRING, itemsize INT,
    shape ARRAY<BIGINT>, row_start BIGINT, data ARRAY<DOUBLE>"""

# The default source of an episode per kind of recording.
DEFAULT_SOURCE = {
    "frames": "replay",
    "demos": "replay",
    "messages": "real",
    "rollout": "sim",
}
