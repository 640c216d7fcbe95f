"""Notes on what was left out of a recording, and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runlens.functions.classify import IMAGE_TYPES
from runlens.functions.flatten import shape_text
from runlens.functions.notes import note
from runlens.operators.ordering import salted_join


def first_two(df: DataFrame, group: Sequence[str], variant: str, pos: str) -> DataFrame:
    """Per group the first variant seen (``a``), the first other one and where.

    Rows are reduced to one per variant before the window, and the rank limit
    lets each task send on two rows per group at most.
    """
    seen = df.groupBy(*group, variant).agg(F.min(pos).alias("_p"))
    rank = F.row_number().over(W.partitionBy(*group).orderBy("_p"))
    top = seen.withColumn("_r", rank).where("_r <= 2")
    return top.groupBy(*group).agg(
        F.max(F.when(F.col("_r") == 1, F.col(variant))).alias("a"),
        F.max(F.when(F.col("_r") == 2, F.col(variant))).alias("b"),
        F.max(F.when(F.col("_r") == 2, F.col("_p"))).alias("b_pos"),
    )


def missing_topics(present: DataFrame, recordings: DataFrame, slot: str, wanted: Sequence[str]) -> DataFrame:
    """Requested topics a recording does not have.

    ``present`` is ``(recording_id, topic, …)`` with one row per topic.
    """
    asked = recordings.select(
        "recording_id", F.explode(F.array(*[F.lit(t) for t in wanted])).alias("item")
    )
    return asked.join(
        present.select("recording_id", F.col("topic").alias("item")), ["recording_id", "item"], "left_anti"
    ).select("recording_id", F.lit(slot).alias("slot"), "item", note("topic_absent").alias("reason"))


def wrong_video_types(present: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Topics asked for as video whose messages are no images."""
    return present.where(F.col("topic").isin(*wanted) & ~F.col("msgtype").isin(*IMAGE_TYPES)).select(
        "recording_id",
        F.lit("video").alias("slot"),
        F.col("topic").alias("item"),
        note("no_image", msgtype=F.col("msgtype")).alias("reason"),
    )


def missing_columns(declared: Sequence[str], present: Sequence[str]) -> list[str]:
    return [c for c in declared if c not in present]


def ragged_columns(df: DataFrame, group: Sequence[str], value: str, pos: str) -> DataFrame:
    """Groups whose list column changes length: ``(…group, a, b, b_pos, reason)``.

    The first row gives the expected length; a NULL row has length 0 and is
    never acceptable. ``reason`` is NULL for groups that can be packed.
    """
    size = F.struct(
        F.coalesce(F.array_size(value), F.lit(0)).alias("len"), F.col(value).isNull().alias("gone")
    )
    out = first_two(df.withColumn("_v", size).select(*group, "_v", pos), group, "_v", pos)
    text = F.when(F.col("a.gone"), note("row_length", row="0", found="0", expected="0")).when(
        F.col("b").isNotNull(),
        note("row_length", row=F.col("b_pos"), found=F.col("b.len"), expected=F.col("a.len")),
    )
    return out.withColumn("reason", text)


def field_counts(rows: DataFrame) -> DataFrame:
    """``(recording_id, topic, field, n, lo, hi)``: messages with the field, least and greatest shape as a number.

    Shapes are numbers here, as a minimum of texts makes Spark sort all fields.
    """
    shape = F.when(F.col("f.scalar"), F.lit(-1)).otherwise(F.coalesce(F.array_size("f.value"), F.lit(-2)))
    long = rows.select("recording_id", "topic", F.explode("fields").alias("f"))
    return long.groupBy("recording_id", "topic", F.col("f.field").alias("field")).agg(
        F.count(F.lit(1)).alias("n"), F.min(shape).alias("lo"), F.max(shape).alias("hi")
    )


def field_summary(rows: DataFrame) -> DataFrame:
    """``(recording_id, topic, field, steady)``: in every usable row with one shape.

    ``rows`` has one row per usable message with its ``fields`` and the number
    of ``usable`` messages of the topic.
    """
    shape = shape_text(F.col("f.value"), F.col("f.scalar"))
    long = rows.select("recording_id", "topic", "usable", F.explode("fields").alias("f"))
    return (
        long.groupBy("recording_id", "topic", F.col("f.field").alias("field"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("usable").alias("rows"),
            F.min(shape).alias("lo"),
            F.max(shape).alias("hi"),
        )
        .select(
            "recording_id",
            "topic",
            "field",
            ((F.col("n") == F.col("rows")) & (F.col("lo") == F.col("hi"))).alias("steady"),
        )
    )


def field_consistency(rows: DataFrame) -> DataFrame:
    """Fields that cannot be stacked: ``(recording_id, topic, field, reason)``.

    The earlier of the two problems is reported, as a reader going
    message by message would see it. Only the fields found unsteady are looked
    at again, so the second pass is as small as the problem.
    """
    key = ["recording_id", "topic"]
    broken = (
        field_summary(rows).where("NOT steady").groupBy(*key).agg(F.collect_list("field").alias("broken"))
    )
    again = salted_join(
        rows.select(*key, "pos", "fields"), broken, key, F.xxhash64("pos")
    ).select(*key, "pos", "fields", F.explode("broken").alias("field"))
    mine = F.filter("fields", lambda f: f["field"] == F.col("field"))
    shape = F.coalesce(
        F.try_element_at(F.transform(mine, lambda f: shape_text(f["value"], f["scalar"])), F.lit(1)),
        F.lit(""),
    )
    seen = first_two(again.select(*key, "pos", "field", shape.alias("shape")), [*key, "field"], "shape", "pos")
    missing = note("field_absent", field=F.col("field"))
    changed = note("field_shape", field=F.col("field"), found=F.col("b"), expected=F.col("a"))
    return seen.select(
        *key, "field", F.when((F.col("a") == "") | (F.col("b") == ""), missing).otherwise(changed).alias("reason")
    )
