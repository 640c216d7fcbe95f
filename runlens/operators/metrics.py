"""Distances between baseline and candidate action series.

Inputs are long tables ``(episode_id, key, step, value ARRAY)`` with steps
numbered 0..n-1 per key. All per-step work is keyed by (episode, step), so one
very long episode spreads over all tasks; only running sums meet per episode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.classify import is_metric_key, key_namespace
from runlens.operators.moments import vector_moments
from runlens.operators.ordering import salted_join
from runlens.session import partitions_by_size

# Fixed values of the out-of-distribution rule.
MIN_BASELINE_ROWS = 5
Z_LIMIT = 3.0
STD_FLOOR = 1e-9

_VECTORS = "map<string,array<double>>"


def action_keys(samples: DataFrame, dtype: str | None = None) -> DataFrame:
    """Only the series the metrics use; ``dtype`` names an optional type column."""
    kind = F.col(dtype) if dtype else F.lit("float32")
    return samples.where(is_metric_key(F.col("key"), kind))


def _vectors_by_step(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row per (episode, step) holding both sides as maps: a single shuffle."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "episode_id",
            "step",
            F.lit(name).alias("side"),
            F.struct("key", F.col("value").cast("array<double>").alias("value")).alias("kv"),
        )

    both = side(action_keys(baseline), "b").unionByName(side(candidate, "c"))
    # Large inputs are dealt out by their size first, else a task's share grows until it spills.
    by_size = partitions_by_size(both)
    if by_size:
        both = both.repartition(*by_size, "episode_id", "step")

    def gather(name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("side") == name, F.col("kv"))), asc=False)

    def by_key(entries: str) -> Column:
        given = F.col(entries)
        # Sorted, so values repeated for one key lie together and the greatest stands first; see repeated_keys.
        before = F.concat(F.array(F.lit(None).cast("struct<key:string,value:array<double>>")), given)
        pairs = F.filter(F.arrays_zip(given.alias("e"), before.alias("p")), lambda x: ~x["e"]["key"].eqNullSafe(x["p"]["key"]))
        firsts = F.map_from_entries(F.filter(pairs["e"], lambda e: e.isNotNull()))
        unique = F.size(F.array_distinct(given["key"])) == F.size(given)
        return F.when(unique, F.map_from_entries(given)).otherwise(firsts)

    sides = both.groupBy("episode_id", "step").agg(gather("b").alias("base"), gather("c").alias("cand"))
    return sides.select("episode_id", "step", by_key("base").alias("base"), by_key("cand").alias("cand"))


def repeated_keys(samples: DataFrame) -> DataFrame:
    """``(episode_id, key, step, n)`` of steps that give one key more than once."""
    return samples.groupBy("episode_id", "key", "step").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _step_distance(base: Column, cand: Column) -> Column:
    """NULL when no key can be paired at this step."""

    def squared(e: Column) -> Column:
        ns = key_namespace(e["key"])
        # Presence decides: a key given as null does not fall back.
        other = F.when(F.map_contains_key(cand, e["key"]), cand[e["key"]]).otherwise(
            F.try_element_at(cand, ns)
        )
        gap = F.aggregate(
            F.zip_with(e["value"], other, lambda x, y: (x - y) * (x - y)),
            F.lit(0.0),
            lambda acc, x: acc + x,
        )
        return F.when(F.size(e["value"]) == F.size(other), gap)

    parts = F.filter(F.transform(F.map_entries(base), squared), lambda x: x.isNotNull())
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(parts) > 0, F.sqrt(total))


def action_l2(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Mean per-step distance over the steps every baseline key has.

    A step lies within the shortest baseline series exactly when all of the
    episode's keys are present there, so sums are kept per (episode, number of
    keys present) and the fullest class is taken: no length join is needed.
    """
    steps = _vectors_by_step(baseline, candidate)
    per_class = (
        steps.select(
            "episode_id",
            F.size("base").alias("width"),
            _step_distance(F.col("base"), F.col("cand")).alias("d"),
        )
        .groupBy("episode_id", "width")
        .agg(F.sum("d").alias("total"), F.count("d").alias("n"))
    )
    best = per_class.groupBy("episode_id").agg(
        F.max_by(F.struct("total", "n"), "width").alias("s")
    )
    return best.select("episode_id", (F.col("s.total") / F.nullif(F.col("s.n"), F.lit(0))).alias("action_l2"))


def action_stats(baseline: DataFrame) -> DataFrame:
    """``(episode_id, key, mean ARRAY, std ARRAY)`` of keys with enough rows.

    Components that too few rows have are left out behind the others.
    """
    vectors = action_keys(baseline).select("episode_id", "key", F.col("value").cast("array<double>").alias("value"))
    found = vector_moments(vectors, ["episode_id", "key"], "value")
    std = F.zip_with("m2", "m", lambda q, m: F.sqrt(q / m))
    floored = F.transform(std, lambda x: F.when(x < STD_FLOOR, 1.0).otherwise(x))
    enough = F.size(F.filter("n", lambda n: n >= MIN_BASELINE_ROWS))
    return found.where(enough > 0).select(
        "episode_id", "key", F.slice("mean", 1, enough).alias("mean"), F.slice(floored, 1, enough).alias("std")
    )


def _largest_z(value: Column, mean: Column, std: Column) -> Column:
    """Largest |z| of one vector; 0 for another width or when any z is NaN."""
    z = F.zip_with(F.zip_with(value, mean, lambda v, m: v - m), std, lambda d, s: F.abs(d / s))
    # NaN sorts above every number, so it is the maximum when there is one.
    top = F.array_max(z)
    return F.when((F.size(value) == F.size(mean)) & ~F.isnan(top), top).otherwise(0.0)


def ood_share(baseline: DataFrame, candidate: DataFrame, every_episode: bool = True) -> DataFrame:
    """Share of candidate steps outside the baseline's per-key distribution.

    Every candidate step with a value for a measured key counts, paired or not.
    Episodes without enough baseline rows or without such a step give NULL, or
    no row at all when ``every_episode`` is off, which saves a pass over both.
    """
    stats = action_stats(baseline)
    given = candidate.where(F.col("value").isNotNull()).select(
        "episode_id", "key", "step", F.col("value").cast("array<double>").alias("value")
    )
    scored = salted_join(given, stats, ["episode_id", "key"], F.col("step"))
    share = (
        scored.groupBy("episode_id", "step")
        .agg(F.max(_largest_z(F.col("value"), F.col("mean"), F.col("std"))).alias("z"))
        .groupBy("episode_id")
        .agg(F.avg((F.col("z") > Z_LIMIT).cast("double")).alias("ood_share"))
    )
    if not every_episode:
        return share
    known = baseline.select("episode_id").union(candidate.select("episode_id")).distinct()
    return known.join(share, "episode_id", "left")


def materialize_steps(sensors: DataFrame) -> DataFrame:
    """Observation maps ``(episode_id, step, obs)``, cut to the shortest series."""
    limits = (
        sensors.groupBy("episode_id", "key")
        .agg(F.max("step").alias("last"))
        .groupBy("episode_id")
        .agg(F.min("last").alias("last"))
    )
    kept = salted_join(sensors, limits, ["episode_id"], F.col("step")).where("step <= last")
    return kept.groupBy("episode_id", "step").agg(
        F.map_from_entries(
            F.collect_list(F.struct("key", F.col("value").cast("array<double>")))
        )
        .cast(_VECTORS)
        .alias("obs")
    )
