"""Outcome signals in free-form metadata and in the last replayed action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where outcomes may be stored and under which names, in order.
PARENTS = (None, "outcome", "lerobot_episode_outcome")
EXTRA_PARENTS = ("hdf5_episode_outcome",)
SUCCESS_KEYS = ("success", "next.success")
REWARD_KEYS = ("reward_total", "next.reward_sum", "reward")
OUTCOME_KEYS = ("success", "reward_total", "collision_count", "time_to_goal_s")

_NUMBER = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"


def _path(parent: str | None, key: str) -> str:
    head = "$" if parent is None else f'$["{parent}"]'
    return f'{head}["{key}"]'


def _at(meta: Column, path: str) -> Column:
    return F.try_variant_get(meta, path, "variant")


def _boolean(meta: Column, path: str) -> Column:
    v = _at(meta, path)
    return F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(meta, path, "boolean"))


def _number(meta: Column, path: str) -> Column:
    v = _at(meta, path)
    return F.when(
        F.schema_of_variant(v).rlike(_NUMBER), F.try_variant_get(meta, path, "double")
    )


def extract_outcome(meta: Column, extended: bool = False) -> Column:
    """``struct(success, reward_total, collision_count, time_to_goal_s)``.

    Per field the first source holding a value of the right JSON type wins.
    Booleans count as numbers; text never does.
    """
    parents = PARENTS + (EXTRA_PARENTS if extended else ())

    def first(getter, keys):
        return F.coalesce(*[getter(meta, _path(p, k)) for p in parents for k in keys])

    rewards = REWARD_KEYS + (("reward_sum", "total_reward") if extended else ())
    return F.struct(
        first(_boolean, SUCCESS_KEYS).alias("success"),
        first(_number, rewards).alias("reward_total"),
        first(_number, ("collision_count",)).alias("collision_count"),
        first(_number, ("time_to_goal_s",)).alias("time_to_goal_s"),
    )


def mirrored(sentinel: Column, key: str, baseline: Column, dtype: str) -> Column:
    """Candidate value: the sentinel's, even when it is null, else the baseline's.

    ``sentinel`` is a variant object or NULL; presence, not nullness, decides.
    """
    present = _at(sentinel, f'$["{key}"]').isNotNull()
    return F.when(present, F.try_variant_get(sentinel, f'$["{key}"]', dtype)).otherwise(baseline)


def mirror_outcome(sentinel: Column, baseline: Column) -> Column:
    kinds = {"success": "boolean"}
    return F.struct(
        *[
            mirrored(sentinel, k, baseline[k], kinds.get(k, "double")).alias(k)
            for k in OUTCOME_KEYS
        ]
    )


def mirror_told(told: Column, baseline: Column) -> Column:
    """As ``mirror_outcome``, of typed fields whose names are listed in ``told.given``."""
    return F.struct(
        *[
            F.when(F.coalesce(F.array_contains(told["given"], k), F.lit(False)), told[k]).otherwise(baseline[k]).alias(k)
            for k in OUTCOME_KEYS
        ]
    )


def merge_metadata(produced: Column, given: Column) -> Column:
    """Shallow merge of two string-keyed maps; the caller's entries win."""
    produced = F.coalesce(produced, F.create_map().cast("map<string,string>"))
    given = F.coalesce(given, F.create_map().cast("map<string,string>"))
    kept = F.map_filter(produced, lambda k, v: ~F.map_contains_key(given, k))
    return F.map_concat(kept, given)
