"""Which slot a topic, column, dataset or file belongs to.

Every rule is a column expression giving ``struct(slot, reason)`` or a
boolean, so classification stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public message types, column names and file extensions.
IMAGE_TYPES = ("sensor_msgs/msg/Image", "sensor_msgs/msg/CompressedImage")
COMMAND_TYPES = (
    "geometry_msgs/msg/Twist",
    "geometry_msgs/msg/TwistStamped",
    "geometry_msgs/msg/Wrench",
    "geometry_msgs/msg/WrenchStamped",
    "trajectory_msgs/msg/JointTrajectory",
    "trajectory_msgs/msg/MultiDOFJointTrajectory",
    "control_msgs/msg/JointJog",
)
FRAME_BOOKKEEPING = ("timestamp", "frame_index", "episode_index", "index", "task_index")
DEMO_BOOKKEEPING = ("timestamp", "timestamps", "frame_index", "episode_index", "index")
DEMO_OUTCOMES = (
    "reward",
    "rewards",
    "done",
    "dones",
    "success",
    "successes",
    "discount",
    "terminated",
    "truncated",
)
DEMO_IMAGE_HINTS = ("image", "rgb", "depth")
VIDEO_EXTENSIONS = (".mp4", ".webm", ".mov", ".m4v")
SENSOR_EXTENSIONS = (".bin", ".npy", ".npz", ".h5", ".hdf5")
ACTION_EXTENSIONS = (".parquet", ".feather", ".arrow")
KNOWN_FORMATS = ("v2.0", "v2.1", "v3.0", "v3.1")


def _verdict(slot: str, reason: str) -> Column:
    return F.struct(F.lit(slot).alias("slot"), F.lit(reason).alias("reason"))


def leaf(path: Column, sep: str = "/") -> Column:
    """Text after the last separator."""
    return F.substring_index(path, sep, -1)


def classify_topic(topic: Column, msgtype: Column) -> Column:
    name = F.lower(leaf(topic))
    return (
        F.when(msgtype.isin(*IMAGE_TYPES), _verdict("video", "msgtype"))
        .when(msgtype.isin(*COMMAND_TYPES), _verdict("actions", "msgtype"))
        .when(name.startswith("cmd_") | (name == "command"), _verdict("actions", "topic-name"))
        .otherwise(_verdict("sensors", "default"))
    )


def classify_column(column: Column) -> Column:
    return (
        F.when(column.isin(*FRAME_BOOKKEEPING), _verdict("internal", "exact"))
        .when(column.startswith("observation.images."), _verdict("video", "prefix"))
        .when((column == "action") | column.startswith("action."), _verdict("actions", "prefix"))
        .when(column.startswith("next."), _verdict("episode_meta", "prefix"))
        .when(column.startswith("observation."), _verdict("sensors", "prefix"))
        .otherwise(_verdict("sensors", "default"))
    )


def classify_dataset(name: Column) -> Column:
    parts = F.filter(F.split(F.lower(name), "/"), lambda s: s != "")
    last = F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lower(name))
    root = F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))
    hinted = F.lit(False)
    for hint in DEMO_IMAGE_HINTS:
        hinted = hinted | last.contains(hint)
    return (
        F.when(last.isin(*DEMO_BOOKKEEPING), _verdict("internal", "exact"))
        .when(
            last.startswith("action") | (root == "action") | root.startswith("action_"),
            _verdict("actions", "leaf"),
        )
        .when(last.isin(*DEMO_OUTCOMES), _verdict("episode_meta", "exact"))
        .when(F.array_contains(parts, "images"), _verdict("video", "segment"))
        .when(hinted, _verdict("video", "leaf"))
        .otherwise(_verdict("sensors", "default"))
    )


def is_camera(shape: Column, kind: Column, itemsize: Column) -> Column:
    """A (T, H, W, C) stack of byte-like pixels."""
    channels = F.try_element_at(shape, F.lit(-1))
    return F.coalesce(
        (F.size(shape) == 4) & channels.isin(1, 3, 4) & ((kind == "u") | (itemsize == 1)),
        F.lit(False),
    )


def demo_slot(name: Column, shape: Column, kind: Column, itemsize: Column) -> Column:
    """Slot of a demonstration dataset; video names without pixels are sensors."""
    slot = classify_dataset(name)["slot"]
    return F.when(
        (slot == "video") & ~is_camera(shape, kind, itemsize), F.lit("sensors")
    ).otherwise(slot)


def kind_from_extension(path: Column) -> Column:
    # A leading dot of the file name is part of the stem, not an extension.
    ext = F.lower(F.regexp_extract(leaf(path), r"^\.*[^.].*?(\.[^.]*)$", 1))
    return (
        F.when(ext.isin(*VIDEO_EXTENSIONS), "video")
        .when(ext.isin(*SENSOR_EXTENSIONS), "sensors")
        .when(ext.isin(*ACTION_EXTENSIONS), "actions")
    )


def format_support(version: Column) -> Column:
    """``ok``, ``newer`` or ``unknown`` for a dataset format version."""
    v = F.coalesce(version, F.lit(""))
    return (
        F.when(v.isin(*KNOWN_FORMATS) | v.startswith("v3"), "ok")
        .when(v.rlike("^v[4-9]"), "newer")
        .otherwise("unknown")
    )


def require_format(version: Column) -> Column:
    """The version itself, or a job failure when it cannot be read."""
    status = format_support(version)
    return F.when(status == "ok", version).otherwise(
        F.raise_error(F.concat(F.lit("dataset format "), F.coalesce(version, F.lit("")), F.lit(" is "), status))
    )


def key_namespace(key: Column) -> Column:
    """Text before the last slash, empty when there is none."""
    return F.left(key, F.greatest(F.length(key) - F.length(leaf(key)) - 1, F.lit(0)))


def key_field(key: Column) -> Column:
    return leaf(key)


def is_metric_key(key: Column, dtype: Column) -> Column:
    """Whether an action series takes part in the distance metrics."""
    numeric = dtype.rlike("^(float|int|uint|complex)[0-9]+$")
    return key.contains("/") & ~key.endswith("/_t_ns") & numeric
