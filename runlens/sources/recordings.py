"""What a message recording holds, without reading payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions.classify import classify_topic
from runlens.functions.outcome import merge_metadata
from runlens.functions.scalars import fixed_text


def topic_summary(messages: DataFrame) -> DataFrame:
    """One row per topic with count, time span and slot."""
    return (
        messages.groupBy("recording_id", "topic", "msgtype")
        .agg(F.count(F.lit(1)).alias("n"), F.min("t_ns").alias("t_min"), F.max("t_ns").alias("t_max"))
        .withColumn("_c", classify_topic(F.col("topic"), F.col("msgtype")))
        .select("*", "_c.slot", "_c.reason")
        .drop("_c")
    )


def bag_summary(messages: DataFrame, recordings: DataFrame) -> DataFrame:
    """Topics with recording totals; empty recordings keep a row without topic."""
    topics = topic_summary(messages)
    totals = topics.groupBy("recording_id").agg(
        F.sum("n").alias("message_count"),
        (F.greatest(F.max("t_max") - F.min("t_min"), F.lit(0)) / 1e9).alias("duration_s"),
    )
    return (
        recordings.select("recording_id")
        .join(totals, "recording_id", "left")
        .join(topics.drop("t_min", "t_max"), "recording_id", "left")
        .withColumn("message_count", F.coalesce("message_count", F.lit(0)))
    )


SLOT_ORDER = ("video", "sensors", "actions")


def topics_in(summary: DataFrame, slots: Sequence[str]) -> DataFrame:
    return summary.where(F.col("slot").isin(*slots))


def artifacts(summary: DataFrame, slots: Sequence[str] = SLOT_ORDER) -> DataFrame:
    """Slots of each recording that hold topics, in the order of ``slots``: ``(recording_id, artifact_no, slot, topics)``.

    Lists are bounded by the number of topics of one recording.
    """
    per = topics_in(summary, slots).groupBy("recording_id", "slot").agg(F.sort_array(F.collect_list("topic")).alias("topics"))
    rank = F.array_position(F.array(*[F.lit(s) for s in slots]), F.col("slot"))
    listed = per.groupBy("recording_id").agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "slot", "topics"))).alias("a"))
    return listed.select("recording_id", F.posexplode("a").alias("artifact_no", "a")).select("recording_id", "artifact_no", "a.slot", "a.topics")


def bag_report(summary: DataFrame) -> DataFrame:
    """Text lines per recording: totals, then topics by slot."""
    slot_rank = F.array_position(F.array(*[F.lit(s) for s in ("video", "sensors", "actions")]), F.col("slot"))
    per = summary.groupBy("recording_id", "message_count", "duration_s").agg(
        F.sort_array(
            F.collect_list(
                F.when(
                    F.col("topic").isNotNull(),
                    F.struct(slot_rank.alias("rank"), "slot", "topic", "msgtype", "n", "reason"),
                )
            )
        ).alias("topics")
    )
    head = F.when(
        F.col("duration_s").isNull(), F.format_string("%s  (empty bag)", F.col("recording_id").cast("string"))
    ).otherwise(
        F.format_string(
            "%s  %ss, %d message%s",
            F.col("recording_id").cast("string"),
            fixed_text(F.col("duration_s"), 2),
            F.col("message_count"),
            F.when(F.col("message_count") == 1, "").otherwise("s"),
        )
    )

    def block(slot: str):
        mine = F.filter("topics", lambda t: t["slot"] == slot)
        lines = F.transform(
            mine,
            lambda t: F.format_string("    %s  (%s, %d msg, via %s)", t["topic"], t["msgtype"], t["n"], t["reason"]),
        )
        return F.when(F.size(mine) > 0, F.concat(F.array(F.lit(f"  {slot}:")), lines)).otherwise(
            F.array().cast("array<string>")
        )

    lines = F.concat(F.array(head), block("video"), block("sensors"), block("actions"))
    return per.select("recording_id", F.posexplode(lines).alias("line_no", "line"))


def provenance(summary: DataFrame, issues: DataFrame, adapter: str, given: DataFrame | None = None) -> DataFrame:
    """Metadata map per recording: totals, topics, notes; the caller's keys win.

    Lists are bounded by the number of topics and fields of one recording.
    """
    facts = summary.groupBy("recording_id", "message_count").agg(
        F.array_join(F.sort_array(F.collect_list("topic")), ",").alias("topics")
    )
    notes = issues.groupBy("recording_id").agg(
        F.array_join(
            F.sort_array(F.collect_list(F.concat_ws(": ", "item", "reason"))), "; "
        ).alias("skipped_topics")
    )
    joined = facts.join(notes, "recording_id", "left")
    made = F.create_map(
        F.lit("adapter"), F.lit(adapter),
        F.lit("bag"), F.col("recording_id").cast("string"),
        F.lit("message_count"), F.col("message_count").cast("string"),
        F.lit("topics"), F.col("topics"),
        F.lit("skipped_topics"), F.col("skipped_topics"),
    )
    made = F.map_filter(made, lambda k, v: v.isNotNull())
    if given is None:
        return joined.select("recording_id", made.alias("metadata"))
    joined = joined.join(given.select("recording_id", F.col("metadata").alias("_given")), "recording_id", "left")
    return joined.select("recording_id", merge_metadata(made, F.col("_given")).alias("metadata"))
