"""Demonstration files as a table of datasets.

``datasets`` holds one row per dataset block: ``(path, demo, name, kind,
itemsize, shape, row_start, data)``. ``demo`` is NULL for files with one
trajectory; ``kind``/``itemsize`` describe the element type, and ``data`` is
flat in row order. Files themselves are opened by an upstream extract.
``attrs`` is ``(path, demo, attrs VARIANT)``; file attributes have a NULL demo.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.classify import classify_dataset, is_camera
from runlens.functions.scalars import demo_order, resolve_fps
from runlens.operators.ordering import number_rows

# Names that mark a single-trajectory file.
ROOT_ACTIONS = ("action", "actions")
OBS_GROUPS = ("obs", "observations")

_NUMBER = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"


def _number(v: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return F.when(kind.rlike(_NUMBER), F.try_variant_get(v, path, "double"))


def env_meta(raw: Column) -> Column:
    """``struct(env_name, robot_type, fps)`` from environment arguments JSON."""
    v = F.try_parse_json(raw)
    robots = F.try_variant_get(v, "$.env_kwargs.robots", "variant")
    kind = F.schema_of_variant(robots)
    freq = _number(v, "$.env_kwargs.control_freq")
    return F.struct(
        F.try_variant_get(v, "$.env_name", "string").alias("env_name"),
        F.when(kind == "STRING", F.try_variant_get(robots, "$", "string"))
        .when(kind.startswith("ARRAY"), F.try_variant_get(robots, "$[0]", "string"))
        .alias("robot_type"),
        F.when(freq > 0, freq).alias("fps"),
    )


def layout(datasets: DataFrame, strict: bool = False) -> DataFrame:
    """``(path, layout)``: ``robomimic``, ``single`` or NULL when unsupported."""
    root = F.substring_index("name", "/", 1)
    single = F.col("name").isin(*ROOT_ACTIONS) | (root.isin(*OBS_GROUPS) & F.col("name").contains("/"))
    found = (
        F.when(F.max(F.col("demo").isNotNull()), "robomimic").when(
            F.max(single & F.col("demo").isNull()), "single"
        )
    )
    if strict:
        found = F.coalesce(found, F.raise_error(F.lit("unsupported demonstration file")))
    return datasets.groupBy("path").agg(found.alias("layout"))


def trajectory_lengths(datasets: DataFrame, attrs: DataFrame) -> DataFrame:
    """``(path, demo, length)``: declared, else from actions, else observations."""
    first_dim = F.when(F.size("shape") >= 1, F.col("shape")[0])
    root = F.substring_index("name", "/", 1)
    depth = F.size(F.split("name", "/"))

    def of(group: str) -> Column:
        return F.min_by(
            first_dim, F.when((root == group) & (depth == 2) & first_dim.isNotNull(), F.col("name"))
        )

    dims = datasets.groupBy("path", "demo").agg(
        *[
            F.max(F.when(F.col("name") == a, first_dim)).alias(f"_{a}")
            for a in ROOT_ACTIONS
        ],
        *[of(g).alias(f"_{g}") for g in OBS_GROUPS],
    )
    declared = attrs.select(
        F.col("path").alias("_p"), F.col("demo").alias("_d"), _number(F.col("attrs"), "$.num_samples").alias("_n")
    )
    joined = dims.join(
        declared, (F.col("path") == F.col("_p")) & F.col("demo").eqNullSafe(F.col("_d")), "left"
    )
    return joined.select(
        "path",
        "demo",
        F.coalesce(
            F.when(F.col("_n") > 0, F.col("_n").cast("bigint")),
            *[F.col(f"_{c}") for c in (*ROOT_ACTIONS, *OBS_GROUPS)],
            F.lit(0).cast("bigint"),
        ).alias("length"),
    )


def episode_refs(lengths: DataFrame) -> DataFrame:
    """Demos of a file in natural order, numbered from 0."""
    order = demo_order(F.coalesce("demo", F.lit("")))
    keyed = lengths.withColumn("_n", order["n"]).withColumn("_key", order["key"])
    return number_rows(keyed, ["path"], ["_n", "_key"], out="index").drop("_n", "_key")


def file_summary(datasets: DataFrame, attrs: DataFrame, user_fps: float | None = None) -> DataFrame:
    """One row per file: layout, demos, first demo's schema, fps, robot, env."""
    per_name = datasets.groupBy("path", "demo", "name").agg(
        F.max(is_camera(F.col("shape"), F.col("kind"), F.col("itemsize"))).alias("pixels")
    )
    order = demo_order(F.coalesce("demo", F.lit("")))
    names = per_name.groupBy("path", "demo").agg(
        F.array_join(F.sort_array(F.collect_list("name")), ",").alias("datasets"),
        F.array_join(
            F.sort_array(
                F.collect_list(
                    F.when((classify_dataset(F.col("name"))["slot"] == "video") & F.col("pixels"), F.col("name"))
                )
            ),
            ",",
        ).alias("cameras"),
    )
    schema = names.groupBy("path").agg(F.min_by(F.struct("datasets", "cameras"), order).alias("s"))
    sizes = trajectory_lengths(datasets, attrs).groupBy("path").agg(
        F.count(F.lit(1)).alias("total_episodes"), F.sum("length").alias("total_steps")
    )
    file_attrs = attrs.where(F.col("demo").isNull()).select("path", "attrs")
    v = F.col("attrs")
    env = env_meta(F.try_variant_get(v, "$.env_args", "string"))
    sim = F.try_variant_get(v, "$.sim", "boolean")
    robomimic = F.col("layout") == "robomimic"
    single_fps = _number(v, "$.fps")
    file_fps = F.when(robomimic, env["fps"]).otherwise(F.when(single_fps > 0, single_fps))
    fps = resolve_fps(F.lit(user_fps).cast("double"), file_fps)
    return (
        layout(datasets)
        .join(schema, "path")
        .join(sizes, "path")
        .join(file_attrs, "path", "left")
        .select(
            "path",
            "layout",
            "total_episodes",
            "total_steps",
            "s.datasets",
            "s.cameras",
            fps["fps"].alias("fps"),
            fps["assumed"].alias("fps_assumed"),
            F.when(robomimic, env["robot_type"])
            .when(sim.isNotNull(), F.when(sim, "sim").otherwise("real"))
            .alias("robot_type"),
            F.when(robomimic, env["env_name"]).alias("env_name"),
        )
    )


def file_report(summary: DataFrame) -> DataFrame:
    """Text lines per file."""
    def line(label: str, value: Column) -> Column:
        return F.when(value.isNotNull() & (value != ""), F.concat(F.lit(f"  {label}: "), value))

    fps = F.concat(F.col("fps").cast("string"), F.when(F.col("fps_assumed"), " (assumed)").otherwise(""))
    lines = F.array(
        F.col("path"),
        line("layout", F.col("layout")),
        line("trajectories", F.col("total_episodes").cast("string")),
        line("fps", fps),
        line("robot_type", F.col("robot_type")),
        line("env", F.col("env_name")),
        line("cameras", F.replace("cameras", F.lit(","), F.lit(", "))),
        line("datasets", F.replace("datasets", F.lit(","), F.lit(", "))),
    )
    return summary.select("path", F.posexplode(F.array_compact(lines)).alias("line_no", "line"))
