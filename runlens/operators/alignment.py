"""Frame rates and index-aligned cameras."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions.scalars import fps_from_median
from runlens.operators.ordering import grouped_median, number_rows, previous_value, salted_join

KEY = ["recording_id", "topic"]


def message_gaps(messages: DataFrame) -> DataFrame:
    """Positive gaps between neighbouring messages of a topic."""
    narrow = messages.select(*KEY, "t_ns", "seq")
    before = previous_value(narrow, KEY, ["t_ns", "seq"], "t_ns", "_prev")
    return before.withColumn("delta", F.col("t_ns") - F.col("_prev")).where("delta > 0").drop("_prev")


def infer_fps(messages: DataFrame) -> DataFrame:
    """Rate of each topic, and whether it is the recording's primary one.

    The primary topic has most messages; the one seen first wins ties.
    """
    topics = messages.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("t_ns", "seq")).alias("first")
    )
    medians = grouped_median(message_gaps(messages), KEY, "delta", "median_ns")
    best = topics.groupBy("recording_id").agg(
        F.max_by("topic", F.struct("n", -F.col("first.t_ns"), -F.col("first.seq"))).alias("primary")
    )
    return (
        topics.join(medians, KEY, "left")
        .join(best, "recording_id")
        .select(
            *KEY,
            "n",
            fps_from_median(F.col("median_ns")).alias("fps"),
            (F.col("topic") == F.col("primary")).alias("is_primary"),
        )
    )


def require_camera(frames: DataFrame, camera: str) -> DataFrame:
    """Only one camera; a recording without it is an error before any work.

    The check fetches at most one offending id.
    """
    has = frames.groupBy("recording_id").agg(
        F.max((F.col("topic") == camera).cast("int")).alias("has")
    )
    lacking = has.where("has = 0").select("recording_id").first()
    if lacking is not None:
        raise ValueError(f"no camera {camera} in recording {lacking['recording_id']}")
    return frames.where(F.col("topic") == camera)


def camera_frames(frames: DataFrame) -> DataFrame:
    """Frame i of every camera side by side, up to the shortest camera.

    ``frames`` is ``(recording_id, topic, t_ns, seq, width, height)``. The
    layout is that of each camera's first frame: widths add up, the tallest
    gives the height.
    """
    numbered = number_rows(frames, KEY, ["t_ns", "seq"], out="frame")
    cameras = frames.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct("width", "height"), F.struct("t_ns", "seq")).alias("size"),
    )
    layout = cameras.groupBy("recording_id").agg(
        F.min("n").alias("n_frames"),
        F.sum("size.width").alias("total_width"),
        F.max("size.height").alias("max_height"),
    )
    aligned = salted_join(
        numbered.select(*KEY, "frame", "seq"), layout, ["recording_id"], F.col("frame")
    ).where("frame < n_frames")
    return aligned.groupBy("recording_id", "frame", "total_width", "max_height").agg(
        F.sort_array(F.collect_list(F.struct("topic", "seq"))).alias("cells")
    )
