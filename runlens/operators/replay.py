"""Replaying a candidate policy over recorded observations."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from runlens.functions.outcome import OUTCOME_KEYS, extract_outcome, mirror_told
from runlens.operators import metrics
from runlens.operators.ordering import salted_join
from runlens.session import materialize

Policy = Callable[[dict[str, Any]], Mapping[str, Any]]

SENTINEL = "_outcome"
_ACTIONS = "ARRAY<STRUCT<key: STRING, value: ARRAY<DOUBLE>>>"
_TOLD = (
    "STRUCT<given: ARRAY<STRING>, success: BOOLEAN, reward_total: DOUBLE, collision_count: DOUBLE, time_to_goal_s: DOUBLE>"
)
_TOLD_ARROW = pa.struct(
    [("given", pa.list_(pa.string())), ("success", pa.bool_())] + [(k, pa.float64()) for k in OUTCOME_KEYS[1:]]
)


def _vector(value: Any) -> np.ndarray | None:
    """Numbers of one action value; what holds none counts as given without numbers."""
    if value is None:
        return None
    try:
        return np.asarray(value, dtype="float64").ravel()
    except (TypeError, ValueError):
        return None


def _told(sentinel: Any) -> dict | None:
    """Outcome fields of a sentinel with their presence; values of another kind are given as null."""
    if not isinstance(sentinel, Mapping):
        return None
    out: dict[str, Any] = {"given": [k for k in OUTCOME_KEYS if k in sentinel]}
    for key in out["given"]:
        value = sentinel[key]
        value = value.item() if isinstance(value, np.generic) else value
        if key == "success":
            out[key] = value if isinstance(value, bool) else None
        else:
            out[key] = float(value) if isinstance(value, (bool, int, float)) else None
    return out


def _act(policy: Policy, obs: dict[str, Any]) -> tuple[list | None, dict | None, str | None]:
    """One step: (actions, sentinel fields, error)."""
    try:
        action = policy(obs)
        if not isinstance(action, Mapping):
            raise TypeError(f"a policy must return a mapping, got {type(action).__name__}")
        rows = [(str(key), _vector(value)) for key, value in action.items() if key != SENTINEL]
        return rows, _told(action.get(SENTINEL)), None
    except Exception as exc:  # noqa: BLE001 - a failing policy fails its episode only
        return None, None, f"{type(exc).__name__}: {exc}"


def _observations(column: pa.MapArray) -> Iterator[dict[str, Any]]:
    """Maps of a batch with array values as views of its buffers."""
    keys, items = column.keys.to_pylist(), column.items
    # Numbers are taken out of a list faster than out of an array.
    flat, ends = items.values.to_numpy(zero_copy_only=False), items.offsets.to_pylist()
    given = items.is_valid().to_pylist() if items.null_count else None
    bounds = column.offsets.to_pylist()
    for i in range(len(column)):
        yield {
            keys[j]: flat[ends[j] : ends[j + 1]] if given is None or given[j] else None
            for j in range(bounds[i], bounds[i + 1])
        }


def _answers(ids: pa.Array, steps: pa.Array, out: list) -> pa.RecordBatch:
    """Policy answers of a batch as Arrow columns."""
    pairs = [pair for rows, _, _ in out for pair in rows or ()]
    sizes = [0 if rows is None else len(rows) for rows, _, _ in out]
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("int32"))
    values = pa.array([v for _, v in pairs], pa.list_(pa.float64()))
    actions = pa.ListArray.from_arrays(
        offsets, pa.StructArray.from_arrays([pa.array([k for k, _ in pairs], pa.string()), values], ["key", "value"])
    )
    return pa.RecordBatch.from_arrays(
        [
            ids,
            steps,
            actions,
            pa.array([o[1] for o in out], _TOLD_ARROW),
            pa.array([o[2] for o in out], pa.string()),
        ],
        ["episode_id", "step", "actions", "sentinel", "error"],
    )


def replay(
    observations: DataFrame,
    policy: Policy | None = None,
    policy_factory: Callable[[], Policy] | None = None,
) -> DataFrame:
    """Call the policy on every observation.

    ``observations`` is ``(episode_id, step, obs MAP)``. A plain ``policy`` sees
    one observation at a time, so steps run wherever they lie and a long episode
    uses the whole cluster. A ``policy_factory`` makes one policy per episode
    that may keep state: its steps then arrive in order within one task, batch
    by batch, and nothing of the episode is held but the policy's own state.
    """
    if (policy is None) == (policy_factory is None):
        raise ValueError("give either policy or policy_factory")
    id_type = observations.schema["episode_id"].dataType.simpleString()
    schema = (
        f"episode_id {id_type}, step BIGINT, actions {_ACTIONS}, sentinel {_TOLD}, error STRING"
    )
    rows = observations.select("episode_id", "step", "obs")

    def stateless(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_act(policy, obs) for obs in _observations(batch.column("obs"))]
            yield _answers(batch.column("episode_id"), batch.column("step"), out)

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, live, broken = object(), None, False
        for batch in batches:
            out = []
            ids = batch.column("episode_id")
            for ep, obs in zip(ids.to_pylist(), _observations(batch.column("obs")), strict=True):
                if ep != current:
                    current, live, broken = ep, policy_factory(), False
                result = (None, None, None) if broken else _act(live, obs)
                broken = broken or result[2] is not None
                out.append(result)
            yield _answers(ids, batch.column("step"), out)

    if policy is not None:
        return rows.mapInArrow(stateless, schema)
    by_episode = rows.repartition("episode_id").sortWithinPartitions("episode_id", "step")
    return by_episode.mapInArrow(ordered, schema)


def replay_resumed(
    observations: DataFrame, policy_factory: Callable[[], Policy], states: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(answers, states)``: replay in order of steps with policies that remember, going on from earlier states.

    ``states`` is ``(episode_id, state BINARY)`` of an earlier call; episodes
    without one get a new policy. A state is the pickled policy and whether it
    has failed, so pass on only states that this function wrote. Each episode is
    read in order, batch by batch, by one task that holds one policy at a time;
    a task that is lost begins again from the stored states. Both results come
    from one stored table.
    """
    id_type = observations.schema["episode_id"].dataType.simpleString()
    schema = f"episode_id {id_type}, step BIGINT, actions {_ACTIONS}, sentinel {_TOLD}, error STRING, state BINARY"
    rows = observations.select("episode_id", "step", "obs", F.lit(None).cast("binary").alias("state"))
    if states is not None:
        # A state stands before all steps of its episode.
        first = F.lit(None).cast("bigint").alias("step"), F.lit(None).cast(observations.schema["obs"].dataType).alias("obs")
        rows = rows.unionByName(states.select("episode_id", *first, "state"))

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import cloudpickle

        current, live, broken, begun = None, None, False, False

        def put_by() -> pa.RecordBatch:
            row = _answers(pa.array([current], ids.type), pa.array([None], pa.int64()), [(None, None, None)])
            return row.append_column("state", pa.array([cloudpickle.dumps((broken, live))], pa.binary()))

        for batch in batches:
            ids, given = batch.column("episode_id"), batch.column("state")
            out, kept, start = [], [], 0
            observed = _observations(batch.column("obs")) if batch.num_rows else iter(())
            for i, (ep, obs) in enumerate(zip(ids.to_pylist(), observed, strict=True)):
                if not begun or ep != current:
                    if out:
                        chosen = pa.array(kept)
                        yield _answers(ids.take(chosen), batch.column("step").take(chosen), out).append_column("state", pa.nulls(len(out), pa.binary()))
                        out, kept = [], []
                    if begun:
                        yield put_by()
                    begun, current, broken, live = True, ep, False, policy_factory()
                if given[i].is_valid:
                    broken, live = cloudpickle.loads(given[i].as_py())
                    continue
                result = (None, None, None) if broken else _act(live, obs)
                broken = broken or result[2] is not None
                out.append(result)
                kept.append(i)
            if out:
                chosen = pa.array(kept)
                yield _answers(ids.take(chosen), batch.column("step").take(chosen), out).append_column("state", pa.nulls(len(out), pa.binary()))
        if begun:
            yield put_by()

    ordered = rows.repartition("episode_id").sortWithinPartitions("episode_id", F.col("step").asc_nulls_first())
    played = materialize(ordered.mapInArrow(in_order, schema), "resumed")
    return played.where("step IS NOT NULL").drop("state"), played.where("state IS NOT NULL").select("episode_id", "state")


def candidate_samples(played: DataFrame) -> DataFrame:
    """Long action series of what the policy answered."""
    return played.select("episode_id", "step", F.inline("actions"))


def replay_summary(played: DataFrame) -> DataFrame:
    """Per episode: steps, the first error and the last action's sentinel."""
    return played.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("step_count"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("step"))).alias("error"),
        F.max_by("sentinel", "step").alias("sentinel"),
    )


def evaluate(
    plan: DataFrame,
    sensors: DataFrame,
    actions: DataFrame,
    metadata: DataFrame,
    policy: Policy | None = None,
    policy_factory: Callable[[], Policy] | None = None,
    run_id: str = "run",
    dry_run: bool = False,
    extended_sources: bool = False,
) -> DataFrame:
    """One result row per planned baseline, in ``pos`` order.

    ``plan`` is ``(pos, baseline_episode_id)`` and may repeat an episode. The
    candidate's steps are written once to the shared folder, so every metric
    sees the same answers even from a policy that is not deterministic.
    """
    wanted = plan.select(F.col("baseline_episode_id").alias("episode_id")).distinct()

    def asked_for(series: DataFrame) -> DataFrame:
        return salted_join(series, wanted, ["episode_id"], F.col("step"), how="left_semi")

    observed = metrics.materialize_steps(asked_for(sensors))
    played = materialize(replay(observed, policy, policy_factory), "replay")
    cand = candidate_samples(played)
    base = asked_for(actions)
    told = metadata.select(
        F.col("episode_id").alias("_m"), extract_outcome(F.col("metadata"), extended_sources).alias("b")
    )
    ids = wanted.withColumnRenamed("episode_id", "_id")

    def on(df: DataFrame, name: str) -> DataFrame:
        return df.withColumnRenamed("episode_id", name)

    joined = (
        ids.join(on(replay_summary(played), "_s"), F.col("_id") == F.col("_s"), "left")
        .join(on(metrics.action_l2(base, cand), "_l"), F.col("_id") == F.col("_l"), "left")
        .join(on(metrics.ood_share(base, cand, every_episode=False), "_o"), F.col("_id") == F.col("_o"), "left")
        .join(told, F.col("_id") == F.col("_m"), "left")
    )
    ok = F.col("error").isNull()
    scored = joined.withColumn("c", mirror_told(F.col("sentinel"), F.col("b")))

    def metric(value: Column) -> Column:
        return F.when(ok, value)

    pairs = []
    for key in ("success", "reward_total", "collision_count", "time_to_goal_s"):
        pairs.append(metric(F.col("b")[key]).alias(f"{key}_baseline"))
        pairs.append(metric(F.col("c")[key]).alias(f"{key}_candidate"))
    candidate_id = (
        F.lit(None).cast("string")
        if dry_run
        else F.when(ok, F.concat_ws("/", F.lit(run_id), F.col("_id").cast("string")))
    )
    results = scored.select(
        F.lit(run_id).alias("eval_run_id"),
        F.col("_id"),
        candidate_id.alias("candidate_episode_id"),
        F.when(ok, "complete").otherwise("failed").alias("status"),
        "error",
        *pairs,
        metric(F.col("action_l2")).alias("action_l2_distance"),
        metric(F.col("ood_share")).alias("ood_action_share"),
        metric(F.coalesce("step_count", F.lit(0))).alias("step_count"),
    )
    return plan.join(results, F.col("baseline_episode_id") == F.col("_id")).drop("_id")


def observed_progress(df: DataFrame, name: str = "progress") -> DataFrame:
    """Attach running counters that a listener or ``Observation`` can read."""
    watch = Observation(name)
    out = df.observe(
        watch,
        F.count(F.lit(1)).alias("episodes"),
        F.count_if(F.col("status") == "complete").alias("completed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    out.observation = watch
    return out


def stored_with_progress(
    results: DataFrame,
    on_progress: Callable[[dict], None] | None = None,
    on_episode: Callable[[dict], None] | None = None,
) -> tuple[DataFrame, dict]:
    """``(stored results, counters)``, with callbacks whose errors change nothing.

    The counters are gathered while the results are written. ``on_progress``
    gets them once; ``on_episode`` gets id, status and error of each row, in
    order of ``pos``, read a partition at a time.
    """
    watched = observed_progress(results, f"progress-{uuid.uuid4().hex[:8]}")
    stored = materialize(watched, "results")
    counters = dict(watched.observation.get)
    if on_progress is not None:
        with contextlib.suppress(Exception):
            on_progress(counters)
    if on_episode is not None:
        for row in stored.select("pos", "baseline_episode_id", "status", "error").orderBy("pos").toLocalIterator():
            with contextlib.suppress(Exception):
                on_episode(row.asDict())
    return stored, counters
