"""Recordings to the long table of per-step samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions import classify
from runlens.functions.flatten import MAX_DEPTH, Flattener, flatten_message, needed_depth
from runlens.functions.notes import note
from runlens.functions.scalars import seconds_to_ns, synthetic_ns
from runlens.operators import quality
from runlens.operators.ordering import number_rows, salted_join
from runlens.session import materialize, spread_small

KEY = ["recording_id", "topic"]


# ── messages ─────────────────────────────────────────────────────────


def stored_flat_messages(
    messages: DataFrame, custom: Mapping[str, Flattener] | None = None
) -> DataFrame:
    """Flat messages written once to the shared folder.

    Packing and its notes read the flat rows several times; parsing every
    payload again for each of them would cost far more than the write.
    """
    spread = spread_small(messages, *KEY, "seq")
    return materialize(flat_messages(spread, custom, needed_depth(messages, custom)), "flat")


def flat_messages(
    messages: DataFrame, custom: Mapping[str, Flattener] | None = None, depth: int = MAX_DEPTH
) -> DataFrame:
    """Messages with ``fields`` and ``failed`` in place of the payload."""
    flat = messages.withColumn("_f", flatten_message(F.col("msgtype"), F.col("payload"), custom, depth))
    return flat.select(
        *KEY,
        "msgtype",
        "t_ns",
        "seq",
        F.struct("t_ns", "seq").alias("pos"),
        F.col("_f.fields").alias("fields"),
        F.col("_f.failed").alias("failed"),
    )


def topic_health(flat: DataFrame) -> DataFrame:
    """Per topic: usable rows and the first flatten error."""
    bad = F.col("failed").isNotNull()
    return flat.groupBy(*KEY).agg(
        F.max("msgtype").alias("msgtype"),
        F.count_if(F.size("fields") > 0).alias("usable"),
        F.min_by("failed", F.when(bad, F.col("pos"))).alias("failed"),
    )


def usable_rows(flat: DataFrame) -> DataFrame:
    """Rows of topics without a flatten error; messages without fields are dropped."""
    good = topic_health(flat).where(F.col("failed").isNull() & (F.col("usable") > 0))
    rows = flat.where(F.size("fields") > 0).drop("failed")
    return salted_join(rows, good.select(*KEY, "usable"), KEY, F.col("seq"))


def message_issues(flat: DataFrame) -> DataFrame:
    """Notes on topics and fields that were left out."""
    health = topic_health(flat)
    slot = classify.classify_topic(F.col("topic"), F.col("msgtype"))["slot"]
    reason = F.when(
        F.col("failed").isNotNull(), note("unreadable", msgtype=F.col("msgtype"), cause=F.col("failed"))
    ).when(F.col("usable") == 0, note("no_numbers"))
    topics = health.select("recording_id", slot.alias("slot"), F.col("topic").alias("item"), reason.alias("reason"))
    rows = usable_rows(flat)
    types = health.select(*KEY, slot.alias("slot"))
    fields = quality.field_consistency(rows).join(types, KEY)
    return topics.where(F.col("reason").isNotNull()).unionByName(
        fields.select("recording_id", "slot", F.col("topic").alias("item"), "reason")
    )


def pack_messages(flat: DataFrame) -> DataFrame:
    """Samples of a flat message stream.

    A field is kept when every usable message of its topic has it with one
    shape; otherwise only that field is dropped. Fields are counted before topics
    are judged, and positions do not depend on other topics, so messages meet the
    verdict of their topic once, by its list of steady fields: each is in every
    usable message, so the list is no longer than a message.
    """
    health = flat.groupBy(*KEY).agg(
        F.count_if(F.size("fields") > 0).alias("usable"), F.max(F.col("failed").isNotNull()).alias("broken")
    )
    good = health.where("NOT broken AND usable > 0").select(*KEY, "usable")
    steady = (
        quality.field_counts(flat)
        .join(good, KEY)
        .where("n = usable AND lo = hi")
        .groupBy(*KEY)
        .agg(F.collect_list("field").alias("steady"))
    )
    given = flat.where(F.size("fields") > 0).drop("failed", "pos")
    numbered = number_rows(given, KEY, ["t_ns", "seq"], keep=[*KEY, "msgtype", "t_ns", "fields"])
    met = salted_join(numbered, steady, KEY, F.col("step"))
    fields = F.filter("fields", lambda f: F.array_contains("steady", f["field"]))
    kept = met.select(*KEY, "msgtype", "t_ns", "step", F.inline(fields))
    return kept.select(
        F.col("recording_id").alias("episode_id"),
        classify.classify_topic(F.col("topic"), F.col("msgtype"))["slot"].alias("slot"),
        F.concat_ws("/", "topic", "field").alias("key"),
        F.col("topic").alias("ns"),
        "field",
        "step",
        "t_ns",
        "value",
        F.when(F.col("scalar"), F.array().cast("array<int>")).otherwise(F.array(F.size("value"))).alias("shape"),
    )


def resolve_slot(topics: DataFrame, slot: str, explicit: Sequence[str] | None = None) -> DataFrame:
    """Topics of one slot: classified ones, or exactly the ones asked for."""
    if explicit is None:
        chosen = topics.where(
            classify.classify_topic(F.col("topic"), F.col("msgtype"))["slot"] == slot
        )
    else:
        chosen = topics.where(F.col("topic").isin(*explicit)) if explicit else topics.where(F.lit(False))
    return chosen.withColumn("slot", F.lit(slot))


# ── per-frame tables ─────────────────────────────────────────────────


def _numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.IntegralType))


def frame_plan(frames: DataFrame, declared: Sequence[str], timestamp: str = "timestamp") -> tuple[list[str], list[str], list[tuple[str, str, str]]]:
    """Split declared columns by schema: ``(scalars, lists, [(column, code, type)])``.

    Only the schema is read; no data is touched.
    """
    types = {f.name: f.dataType for f in frames.schema.fields}
    if timestamp not in types:
        return [], [], [("*", "no_clock", timestamp)]
    scalars, lists, notes = [], [], []
    for name in declared:
        kind = types.get(name)
        if kind is None:
            notes.append((name, "column_absent", ""))
        elif _numeric(kind):
            scalars.append(name)
        elif isinstance(kind, T.ArrayType) and _numeric(kind.elementType):
            lists.append(name)
        else:
            notes.append((name, "column_type", kind.simpleString()))
    return scalars, lists, notes


def pack_frames(
    frames: DataFrame,
    declared: Sequence[str],
    episode: str = "episode_index",
    index: str = "frame_index",
    timestamp: str = "timestamp",
) -> tuple[DataFrame, DataFrame]:
    """``(samples, issues)`` of a per-frame table, for all episodes at once."""
    spark = frames.sparkSession
    scalars, lists, notes = frame_plan(frames, declared, timestamp)
    issue_type = "recording_id STRING, slot STRING, item STRING, reason STRING"
    slot_of = classify.classify_column(F.col("item"))["slot"]
    static = spark.createDataFrame(
        [(None, None, c, f"{code} type={kind}" if code == "column_type" else code) for c, code, kind in notes], issue_type
    ).withColumn("slot", slot_of)
    series = [
        F.struct(F.lit(c).alias("column"), F.array(F.col(f"`{c}`").cast("float")).alias("value"), F.lit(True).alias("scalar"))
        for c in scalars
    ] + [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("array<float>").alias("value"), F.lit(False).alias("scalar"))
        for c in lists
    ]
    if not series:
        empty = spark.createDataFrame([], "episode_id STRING, slot STRING, key STRING, step BIGINT, t_ns BIGINT, value ARRAY<FLOAT>")
        return empty, static
    long = frames.select(
        F.col(episode).alias("episode_id"),
        F.col(index).cast("bigint").alias("step"),
        seconds_to_ns(F.col(f"`{timestamp}`")).alias("t_ns"),
        F.inline(F.array(*series)),
    )
    issues = static
    if lists:
        ragged = quality.ragged_columns(
            long.where(~F.col("scalar")), ["episode_id", "column"], "value", "step"
        )
        # Empty lists are dropped without a note. What is left out is stored, as samples may be read several times; it is
        # small unless the data are broken, and Spark then broadcasts it by its size instead of shuffling all samples.
        left_out = materialize(ragged.where(F.col("reason").isNotNull() | (F.col("a.len") == 0)), "ragged")
        bad = left_out.where(F.col("reason").isNotNull())
        issues = static.unionByName(
            bad.select(
                F.col("episode_id").cast("string").alias("recording_id"),
                F.lit(None).cast("string").alias("slot"),
                F.col("column").alias("item"),
                "reason",
            ).withColumn("slot", slot_of)
        )
        drop = left_out.select("episode_id", "column", F.lit(True).alias("dropped"))
        long = salted_join(long, drop, ["episode_id", "column"], F.col("step"), how="left").where(
            F.col("dropped").isNull()
        )
    samples = long.select(
        "episode_id",
        classify.classify_column(F.col("column"))["slot"].alias("slot"),
        F.concat(F.col("column"), F.lit("/value")).alias("key"),
        F.col("column").alias("ns"),
        F.lit("value").alias("field"),
        "step",
        "t_ns",
        "value",
        F.when(F.col("scalar"), F.array().cast("array<int>")).otherwise(F.array(F.size("value"))).alias("shape"),
    )
    return samples, issues


# ── demonstrations ───────────────────────────────────────────────────


def pack_demos(datasets: DataFrame, fps: Column) -> DataFrame:
    """Samples of demonstration datasets stored in row blocks.

    ``datasets`` is ``(path, demo, name, kind, itemsize, shape, row_start,
    data)`` with ``data`` flat in row order; images carry no data here.
    """
    slot = classify.demo_slot(F.col("name"), F.col("shape"), F.col("kind"), F.col("itemsize"))
    width = F.coalesce(
        F.aggregate(
            F.slice("shape", 2, F.greatest(F.size("shape") - 1, F.lit(1))),
            F.lit(1).cast("bigint"),
            lambda acc, d: acc * d,
        ),
        F.lit(1).cast("bigint"),
    ).cast("int")
    usable = datasets.withColumn("slot", slot).where(
        F.col("slot").isin("sensors", "actions") & (F.size("shape") > 0) & (F.col("shape")[0] > 0)
    )
    rows = usable.withColumn("width", width).where(F.size("data") > 0)
    steps = rows.select(
        "path",
        "demo",
        "slot",
        "name",
        "row_start",
        "width",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), (F.size("data") / F.col("width")).cast("int") - 1),
                lambda i: F.slice("data", i * F.col("width") + 1, F.col("width")),
            )
        ).alias("i", "value"),
    ).withColumn("step", F.col("row_start") + F.col("i"))
    return steps.select(
        "path",
        "demo",
        "slot",
        F.concat(F.col("name"), F.lit("/value")).alias("key"),
        F.col("step").cast("bigint").alias("step"),
        synthetic_ns(F.col("step"), fps).alias("t_ns"),
        F.col("value").cast("array<float>").alias("value"),
    )


def demo_issues(datasets: DataFrame) -> DataFrame:
    """Datasets that hold nothing to pack."""
    empty = (F.size("shape") == 0) | (F.col("shape")[0] == 0)
    slot = classify.demo_slot(F.col("name"), F.col("shape"), F.col("kind"), F.col("itemsize"))
    return datasets.where(empty & slot.isin("sensors", "actions")).select(
        F.col("path").alias("recording_id"),
        slot.alias("slot"),
        F.col("name").alias("item"),
        note("nothing_stored").alias("reason"),
    )


# ── rollouts ─────────────────────────────────────────────────────────


def pack_rollout(steps: DataFrame, fps: float = 30.0) -> DataFrame:
    """Series of logged rollouts; keys absent in any step are dropped.

    ``steps`` is ``(episode_id, step, key, value ARRAY)``.
    """
    per_key = steps.groupBy("episode_id", "key").agg(
        F.count(F.lit(1)).alias("n"), F.max("step").alias("last")
    )
    length = per_key.groupBy("episode_id").agg((F.max("last") + 1).alias("length"))
    whole = per_key.join(length, "episode_id").where(F.col("n") == F.col("length"))
    kept = salted_join(steps, whole.select("episode_id", "key"), ["episode_id", "key"], F.col("step"))
    return kept.select(
        "episode_id",
        F.concat(F.col("key"), F.lit("/value")).alias("key"),
        "step",
        synthetic_ns(F.col("step"), F.lit(fps)).alias("t_ns"),
        F.col("value").cast("array<float>").alias("value"),
    )
