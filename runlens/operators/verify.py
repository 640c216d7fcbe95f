"""Run rollups, scenario results and the ship-or-hold gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.scalars import number_text
from runlens.operators.ordering import row_hash, salted_join
from runlens.session import materialize

# name, baseline expression, candidate expression, whether higher is better
# (NULL: only one value exists per row, so there is no direction).
ROLLUP_METRICS = (
    ("success_rate", True),
    ("reward_mean", True),
    ("collision_rate", False),
    ("time_to_goal_s", False),
    ("ood_action_share", None),
)


def run_counters(results: DataFrame, keys: Sequence[str] = ("eval_run_id",)) -> DataFrame:
    return results.groupBy(*keys).agg(
        F.count_if(F.col("status") == "complete").alias("episodes_completed"),
        F.count_if(F.col("status") == "failed").alias("episodes_failed"),
    )


def _side(side: str) -> dict[str, Column]:
    return {
        "success_rate": F.avg(F.col(f"success_{side}").cast("double")),
        "reward_mean": F.avg(f"reward_total_{side}"),
        "collision_rate": F.avg((F.col(f"collision_count_{side}") > 0).cast("double")),
        "time_to_goal_s": F.avg(f"time_to_goal_s_{side}"),
    }


def run_rollup(results: DataFrame, keys: Sequence[str] = ("eval_run_id",)) -> DataFrame:
    """Per run an array ``metrics`` of five comparisons and the recommendation."""
    base, cand = _side("baseline"), _side("candidate")
    aggs = [v.alias(f"b_{k}") for k, v in base.items()]
    aggs += [v.alias(f"c_{k}") for k, v in cand.items()]
    wide = (
        results.where(F.col("status") == "complete")
        .groupBy(*keys)
        .agg(*aggs, F.avg("ood_action_share").alias("c_ood_action_share"))
    )
    rows = []
    for name, higher in ROLLUP_METRICS:
        b = F.col(f"b_{name}") if name in base else F.lit(None).cast("double")
        c = F.col(f"c_{name}")
        delta = c - b
        better = (delta > 0) if higher else (delta < 0)
        rows.append(
            F.struct(
                F.lit(name).alias("metric"),
                b.alias("baseline"),
                c.alias("candidate"),
                delta.alias("delta"),
                better.alias("delta_is_better"),
            )
        )
    out = wide.select(*keys, F.array(*rows).alias("metrics"))
    total = F.size(F.filter("metrics", lambda m: m["delta"].isNotNull()))
    better = F.size(F.filter("metrics", lambda m: m["delta_is_better"]))
    worse_success = F.coalesce(F.col("metrics")[0]["delta"] < 0, F.lit(False))
    return out.select(
        *keys,
        "metrics",
        better.cast("bigint").alias("better_count"),
        total.cast("bigint").alias("metric_total"),
        F.when((better * 2 > total) & ~worse_success, "ship").otherwise("hold").alias("recommend"),
    )


def rollup_report(rollup: DataFrame, keys: Sequence[str] = ("eval_run_id",)) -> DataFrame:
    """Text lines of a rollup: five metrics, then the recommendation."""

    def line(m: Column) -> Column:
        better = m["delta_is_better"]
        sign = F.when(better.isNull(), " ").when(better, "✓").otherwise("✗")
        return F.format_string(
            "  %s %-20s baseline=%10s  candidate=%10s  Δ=%10s",
            sign,
            m["metric"],
            number_text(m["baseline"]),
            number_text(m["candidate"]),
            number_text(m["delta"], signed=True),
        )

    last = F.format_string(
        "Recommend: %s  (%d/%d metrics better)", "recommend", "better_count", "metric_total"
    )
    lines = F.concat(F.transform("metrics", line), F.array(last))
    return rollup.select(*keys, F.posexplode(lines).alias("line_no", "line"))


def verification_status(status: Column, success_candidate: Column) -> Column:
    """Result of one scenario replay; an unknown success is a failure."""
    return (
        F.when(status == "failed", "error")
        .when((status == "complete") & success_candidate.eqNullSafe(F.lit(True)), "pass")
        .otherwise("fail")
    )


def scenario_of_baseline(scenarios: DataFrame, pos: str) -> DataFrame:
    """One scenario per baseline episode: the last one listed."""
    return scenarios.groupBy("baseline_episode_id").agg(
        F.max_by("scenario_id", pos).alias("scenario_id")
    )


def scenario_results(results: DataFrame, scenarios: DataFrame, pos: str) -> DataFrame:
    """Verification rows for finished replays; unknown episodes are ignored."""
    found = salted_join(
        results, scenario_of_baseline(scenarios, pos), ["baseline_episode_id"], row_hash(results)
    )
    return found.withColumn(
        "verify_status", verification_status(F.col("status"), F.col("success_candidate"))
    )


def mirror_results(results: DataFrame, scenarios: DataFrame, pos: str, candidate: str) -> DataFrame:
    """Results of a finished run as rows for the scenarios of its baselines."""
    return scenario_results(results, scenarios, pos).select(
        "scenario_id",
        F.lit(candidate).alias("candidate_policy_version"),
        F.col("verify_status").alias("status"),
        "eval_run_id",
        F.col("baseline_episode_id"),
    )


def record_results(results: DataFrame) -> DataFrame:
    """Fill in the status of recorded results that came without one."""
    return results.withColumn(
        "status",
        F.coalesce(
            "status",
            F.when(F.col("error").isNotNull(), "error").otherwise(
                verification_status(F.lit("complete"), F.col("success_candidate"))
            ),
        ),
    )


def latest_status(results: DataFrame, order: Sequence[str]) -> DataFrame:
    """Newest status per scenario and candidate; combined before the shuffle."""
    return results.groupBy("scenario_id", "candidate_policy_version").agg(
        F.max_by("status", F.struct(*order)).alias("latest_status")
    )


def pending_critical(scenarios: DataFrame) -> DataFrame:
    return scenarios.where(
        (F.col("severity") == "critical") & ~F.col("latest_status").eqNullSafe(F.lit("pass"))
    )


def with_status(scenarios: DataFrame, latest: DataFrame, candidate: str) -> DataFrame:
    one = latest.where(F.col("candidate_policy_version") == candidate).select(
        "scenario_id", "latest_status"
    )
    return scenarios.join(one, "scenario_id", "left")


def gate(scenarios: DataFrame, latest: DataFrame) -> DataFrame:
    """One row per candidate that has results.

    Pending scenarios are the critical total less those with a result, so no
    scenario-by-candidate product is formed.
    """
    critical = scenarios.where(F.col("severity") == "critical").select("scenario_id")
    total = critical.agg(F.count(F.lit(1)).alias("n"))
    seen = (
        latest.join(critical.withColumn("critical", F.lit(True)), "scenario_id", "left")
        .groupBy("candidate_policy_version")
        .agg(
            F.count_if(F.col("critical") & (F.col("latest_status") == "pass")).alias("critical_passed"),
            F.count_if(F.col("critical") & (F.col("latest_status") != "pass")).alias("critical_failed"),
        )
    )
    all_critical = total.scalar()
    return seen.select(
        "candidate_policy_version",
        all_critical.alias("critical_total"),
        "critical_passed",
        "critical_failed",
        (all_critical - F.col("critical_passed") - F.col("critical_failed")).alias("critical_pending"),
    ).withColumn("passed", F.col("critical_passed") == F.col("critical_total"))


def gate_body(scenarios: DataFrame, latest: DataFrame, candidates: DataFrame) -> DataFrame:
    """The gate of every candidate, also of those without results, with the names of its scenarios and blockers.

    ``candidates`` is ``(candidate_policy_version)``. The critical scenarios are
    one sorted list for all; a candidate's blockers are the places of that list
    without those it passed, so scenarios and candidates are never multiplied
    out. Places are plain numbers, which ``array_except`` finds by hash; records
    it would compare one by one with all others.
    """
    named = scenarios.where(F.col("severity") == "critical").select("name", "scenario_id")
    listed = named.agg(F.sort_array(F.collect_set(F.struct("name", "scenario_id"))).alias("s"))
    everything = listed.scalar()
    placed = listed.select(F.posexplode("s").alias("_place", "_s")).select("_place", F.col("_s.scenario_id").alias("scenario_id"))
    told = latest.join(placed, "scenario_id").groupBy("candidate_policy_version").agg(
        F.collect_set(F.when(F.col("latest_status") == "pass", F.col("_place"))).alias("passed_places"),
        F.count_if(F.col("latest_status") != "pass").alias("critical_failed"),
    )
    out = candidates.select("candidate_policy_version").distinct().join(told, "candidate_policy_version", "left")
    out = out.select(
        "candidate_policy_version",
        everything.alias("_all"),
        F.coalesce("passed_places", F.array().cast("array<int>")).alias("_passed"),
        F.coalesce("critical_failed", F.lit(0)).alias("critical_failed"),
    )
    size = lambda c: F.size(c).cast("bigint")
    places = F.when(F.size("_all") > 0, F.sequence(F.lit(0), F.size("_all") - 1)).otherwise(F.array().cast("array<int>"))
    blocked = F.array_except(places, F.col("_passed"))
    return out.select(
        "candidate_policy_version",
        size("_all").alias("critical_total"),
        size("_passed").alias("critical_passed"),
        "critical_failed",
        (size("_all") - size("_passed") - F.col("critical_failed")).alias("critical_pending"),
        (size("_all") == size("_passed")).alias("passed"),
        F.col("_all.name").alias("scenarios"),
        F.transform(blocked, lambda k: F.get("_all", k)["name"]).alias("blockers"),
    )


def gate_of(scenarios: DataFrame, latest: DataFrame, candidate: str) -> DataFrame:
    """The gate of one candidate, also when it has no results yet: one row."""
    known = with_status(scenarios, latest, candidate)
    critical = F.col("severity") == "critical"
    status = F.col("latest_status")
    return known.agg(
        F.count_if(critical).alias("critical_total"),
        F.count_if(critical & (status == "pass")).alias("critical_passed"),
        F.count_if(critical & (status != "pass")).alias("critical_failed"),
        F.count_if(critical & status.isNull()).alias("critical_pending"),
    ).withColumn("passed", F.col("critical_passed") == F.col("critical_total"))


def blockers(scenarios: DataFrame, latest: DataFrame, candidate: str) -> DataFrame:
    """Critical scenarios that keep the candidate from shipping, one per row."""
    return pending_critical(with_status(scenarios, latest, candidate))


def run_check(
    scenarios: DataFrame,
    results: DataFrame,
    order: Sequence[str],
    candidate: str,
    evaluate: Callable[[DataFrame], DataFrame],
    pos: str = "scenario_id",
    dry_run: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Replay what is pending and gate again: ``(gate row, new results)``.

    ``evaluate`` maps a plan ``(pos, baseline_episode_id)`` to result rows. A
    candidate whose gate is already open has nothing pending, so the same plan
    covers both cases. A dry run adds nothing to the gate.
    """
    # Both are small and read many times below; results are scanned once.
    mine = results.where(F.col("candidate_policy_version") == candidate)
    latest = materialize(latest_status(mine, order), "latest")
    todo = materialize(blockers(scenarios, latest, candidate), "pending")
    # A baseline is replayed once, however many scenarios it serves.
    plan = todo.groupBy("baseline_episode_id").agg(F.min(pos).alias("pos")).select("pos", "baseline_episode_id")
    # Results are stored once: they are the record of the check.
    fresh = materialize(
        scenario_results(evaluate(plan), todo, pos).withColumn(
            "candidate_policy_version", F.lit(candidate)
        ),
        "check",
    )
    if dry_run:
        after = latest
    else:
        renewed = fresh.groupBy("scenario_id", "candidate_policy_version").agg(
            F.min("verify_status").alias("latest_status")  # error before fail before pass
        )
        kept = latest.join(renewed, ["scenario_id", "candidate_policy_version"], "left_anti")
        after = kept.unionByName(renewed)
    verdict = gate_of(scenarios, after, candidate)
    return verdict.withColumn("exit_code", F.when(F.col("passed"), 0).otherwise(1)), fresh


def promote(requests: DataFrame, existing: DataFrame, pos: str) -> DataFrame:
    """Promote episodes to scenarios, once per episode.

    Of several requests for one new episode the first creates the scenario; all
    others, and requests for known episodes, return the one that exists.
    """
    known = existing.groupBy("baseline_episode_id").agg(F.min("scenario_id").alias("_known"))
    first = requests.groupBy("baseline_episode_id").agg(F.min(pos).alias("_first"))
    facts = first.join(known, "baseline_episode_id", "left")
    return salted_join(requests, facts, ["baseline_episode_id"], F.xxhash64(pos)).select(
        *[c for c in requests.columns if c != "severity"],
        (
            F.coalesce("severity", F.lit("warning")) if "severity" in requests.columns else F.lit("warning")
        ).alias("severity"),
        F.coalesce(
            "_known", F.concat(F.lit("scenario-"), F.col("baseline_episode_id").cast("string"))
        ).alias("scenario_id"),
        (F.col("_known").isNull() & (F.col(pos) == F.col("_first"))).alias("promoted"),
    )
