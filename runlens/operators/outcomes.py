"""Episode outcomes from per-step records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.classify import classify_dataset
from runlens.operators.ordering import salted_join


def frame_outcomes(
    frames: DataFrame, columns: Sequence[str], episode: str, index: str
) -> DataFrame:
    """Last frame's value of each column, and the summed reward.

    One combinable aggregate: ``(episode, outcome STRUCT, reward_sum)``. Numbers
    and flags are kept one by one, by the same comparisons: a struct, as a text,
    would make Spark sort all frames by episode instead of hashing them.
    """
    quoted = [F.col(f"`{c}`").alias(c) for c in columns]
    kinds = [frames.schema[c].dataType for c in columns]
    if all(isinstance(k, (T.NumericType, T.BooleanType)) for k in kinds):
        last = F.when(F.max(index).isNotNull(), F.struct(*[F.max_by(q, index).alias(c) for c, q in zip(columns, quoted)]))
    else:
        last = F.max_by(F.struct(*quoted), index)
    aggs = [last.alias("outcome")]
    if "next.reward" in columns:
        aggs.append(F.sum(F.col("`next.reward`").cast("double")).alias("reward_sum"))
    return frames.groupBy(episode).agg(*aggs)


def demo_outcomes(datasets: DataFrame, keys: Sequence[str] = ("path", "demo")) -> DataFrame:
    """Last element per outcome leaf, and the reward sum, of demonstrations.

    ``datasets`` comes in row blocks ``(…keys, name, row_start, data)``. Blocks
    are reduced to one number each before the shuffle; a later name wins when
    two datasets share a leaf.
    """
    leaf = F.substring_index("name", "/", -1)
    slot = classify_dataset(F.col("name"))["slot"]
    blocks = datasets.where((slot == "episode_meta") & (F.size("data") > 0)).select(
        *keys,
        "name",
        leaf.alias("leaf"),
        "row_start",
        F.element_at("data", -1).alias("last"),
        F.aggregate("data", F.lit(0.0), lambda acc, x: acc + x).alias("total"),
    )
    per_name = blocks.groupBy(*keys, "leaf", "name").agg(
        F.max_by("last", "row_start").alias("last"), F.sum("total").alias("total")
    )
    rewarded = F.when(F.col("leaf").isin("reward", "rewards"), F.col("name"))
    last = F.struct("name", "leaf", "last")
    # The number of outcome leaves of one trajectory is small and fixed by name.
    gathered = per_name.groupBy(*keys).agg(
        F.sort_array(F.collect_list(last)).alias("leaves"), F.max_by("total", rewarded).alias("reward_sum")
    )
    latest = F.filter(
        "leaves", lambda e: ~F.exists("leaves", lambda o: (o["leaf"] == e["leaf"]) & (o["name"] > e["name"]))
    )
    return gathered.select(
        *keys,
        F.map_from_entries(F.transform(latest, lambda e: F.struct(e["leaf"], e["last"]))).alias("outcome"),
        "reward_sum",
    )


def rollout_totals(
    steps: DataFrame, episode: str = "episode_id", fps: float = 30.0, max_steps: int | None = None
) -> DataFrame:
    """Reward, length and ending of logged rollouts.

    A rollout ends at its first terminal step; all logged steps up to it count
    unless ``max_steps`` is given. The ending is found by a combinable minimum,
    so no episode is gathered in one place.
    """
    if max_steps is not None:
        steps = steps.where(F.col("step") < max_steps)
    done = F.col("terminated") | F.col("truncated")
    stop = steps.groupBy(episode).agg(F.min(F.when(done, F.col("step"))).alias("_stop"))
    within = salted_join(steps, stop, [episode], F.col("step")).where(F.col("_stop").isNull() | (F.col("step") <= F.col("_stop")))
    return within.groupBy(episode).agg(
        F.sum(F.col("reward").cast("double")).alias("total_reward"),
        F.count(F.lit(1)).alias("steps"),
        F.max_by("terminated", "step").alias("terminated"),
        F.max_by("truncated", "step").alias("truncated"),
        (F.count(F.lit(1)) / F.lit(float(fps))).alias("duration_s"),
    )
