"""The episode catalogue: logging, finalizing, planning, looking up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.classify import kind_from_extension
from runlens.functions.notes import note
from runlens.functions.scalars import clamp_failure_time, stripped


def failure_time_problem(status: Column, failure_time: Column) -> Column:
    """Why a failure time cannot be stored; NULL when it can."""
    return F.when(failure_time < 0, note("range", field="failure_time_s", low="0")).when(
        failure_time.isNotNull() & ~status.eqNullSafe(F.lit("failed")),
        F.lit("failure_time_s needs status failed"),
    )


def checked_failure_time(status: Column, failure_time: Column, duration: Column) -> Column:
    """``struct(problem, value)``."""
    problem = failure_time_problem(status, failure_time)
    return F.struct(
        problem.alias("problem"),
        F.when(problem.isNull(), clamp_failure_time(failure_time, duration)).alias("value"),
    )


def artifact_problem(path: Column, slot: Column) -> Column:
    """Why a file cannot go into a slot; unknown extensions are accepted."""
    kind = kind_from_extension(path)
    return F.when(kind.isNotNull() & (kind != slot), F.concat(F.lit("file looks like "), kind))


def log_episodes(runs: DataFrame, source: str) -> DataFrame:
    """Catalogue rows for finished runs.

    ``runs`` has ``status``, ``failure_time_s``, ``duration_s`` and
    ``upload_error``; an upload error makes the episode failed with a reason,
    and a broken failure time is reported in ``problem``.
    """
    error = F.col("upload_error")
    status = F.when(error.isNotNull(), "failed").otherwise(F.col("status"))
    checked = checked_failure_time(F.col("status"), F.col("failure_time_s"), F.col("duration_s"))
    return runs.select(
        *[c for c in runs.columns if c not in ("status", "failure_time_s", "upload_error", "source")],
        (F.coalesce("source", F.lit(source)) if "source" in runs.columns else F.lit(source)).alias("source"),
        status.alias("status"),
        checked["value"].alias("failure_time_s"),
        checked["problem"].alias("problem"),
        F.when(error.isNotNull(), F.concat(F.lit("upload error: "), error)).alias("failure_reason"),
    )


def exit_status(exc_type: Column, exc_message: Column) -> Column:
    """``struct(status, failure_reason)`` at the end of a recording block."""
    return F.struct(
        F.when(exc_type.isNull(), "ready").otherwise("failed").alias("status"),
        F.when(exc_type.isNotNull(), F.concat_ws(": ", exc_type, exc_message)).alias("failure_reason"),
    )


def finalize(calls: DataFrame, artifacts: DataFrame, order: Sequence[str]) -> DataFrame:
    """First finalize per episode wins; bytes are explicit or the artifacts' sum."""
    fields = [c for c in calls.columns if c not in ("episode_id", *order)]
    first = calls.groupBy("episode_id").agg(
        F.min_by(F.struct(*fields), F.struct(*order)).alias("f")
    )
    sizes = artifacts.groupBy("episode_id").agg(F.sum("bytes_size").alias("_sum"))
    out = first.join(sizes, "episode_id", "left").select("episode_id", "f.*", "_sum")
    total = F.nullif(F.coalesce("bytes_total", "_sum"), F.lit(0).cast("bigint"))
    return out.withColumn("bytes_total", total).drop("_sum")


def upsert(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write per key."""
    fields = [c for c in rows.columns if c not in (*keys, *order)]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("r"))
    return last.select(*keys, "r.*")


def eval_plan(requests: DataFrame, episodes: DataFrame) -> DataFrame:
    """Requested baselines ``(pos, token)`` in order, repeats kept.

    Tokens are trimmed; blanks and ``#`` lines are dropped; ids without an
    episode are kept with ``known`` false. Neither side is small, so they meet
    in a sort-merge join; the adaptive skew join splits an id that very many ask for.
    """
    asked = (
        requests.withColumn("baseline_episode_id", stripped(F.col("token")))
        .where((F.col("baseline_episode_id") != "") & ~F.col("baseline_episode_id").startswith("#"))
        .drop("token")
    )
    ids = episodes.select(F.col("episode_id").cast("string").alias("baseline_episode_id")).distinct()
    found = asked.join(ids.withColumn("known", F.lit(True)).hint("merge"), "baseline_episode_id", "left")
    return found.withColumn("known", F.coalesce("known", F.lit(False)))


def require_run(candidate_version: Column) -> Column:
    """Trimmed version of a run; a blank one fails the job."""
    v = stripped(candidate_version)
    return F.when(F.length(v) > 0, v).otherwise(
        F.raise_error(F.lit("a run needs a candidate policy version"))
    )


def lookup(wanted: DataFrame, episodes: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Episodes for wanted keys; absent ones have ``found`` false, or fail."""
    hit = wanted.join(episodes.withColumn("found", F.lit(True)), key, "left")
    found = F.coalesce("found", F.lit(False))
    if strict:
        found = F.when(found, True).otherwise(
            F.raise_error(F.concat(F.lit("no episode "), F.col(key).cast("string")))
        )
    return hit.withColumn("found", found)


def subset(episodes: DataFrame, index: str, wanted: DataFrame) -> DataFrame:
    """Episodes in the order asked for, with an error for each index out of range.

    ``wanted`` is ``(pos, index)``.
    """
    hit = wanted.join(episodes.withColumn("_in", F.lit(True)), index, "left")
    return hit.withColumn(
        "error",
        F.when(
            F.col("_in").isNull(),
            F.concat(F.lit("episode_index="), F.col(index).cast("string"), F.lit(" is out of range")),
        ),
    ).drop("_in")


def bulk_status(items: DataFrame, error: str, pos: str, stop_on_error: bool = False) -> DataFrame:
    """Per-item outcome; with ``stop_on_error`` items after the first error are left out."""
    out = items.withColumn("ok", F.col(error).isNull())
    if not stop_on_error:
        return out
    first = items.agg(F.min(F.when(F.col(error).isNotNull(), F.col(pos))).alias("p")).scalar()
    return out.where(first.isNull() | (F.col(pos) <= first))
