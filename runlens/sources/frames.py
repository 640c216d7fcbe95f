"""Per-frame parquet datasets: metadata tables and frame scans.

A dataset root holds ``meta/info.json``, episode and task tables below
``meta/`` and frames below ``data/``. Metadata operators never touch frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.classify import FRAME_BOOKKEEPING, format_support, require_format
from runlens.functions.scalars import stripped
from runlens.operators.ordering import number_rows, row_hash, salted_join
from runlens.session import materialize

FRAME_NAME = r"chunk-(\d+)/episode_(\d+)\.parquet"
FRAME_FILES = "episode_*.parquet"
DEFAULT_CHUNK = 1000
CAMERA_PREFIX = "observation.images."


# ── frames ───────────────────────────────────────────────────────────


def scan_frames_v2(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Frames of one file per episode, with ``episode_index`` from the path.

    When an episode lies in both chunkings, the directory for chunks of 1000
    wins. Files that lose are found from the listed paths in a Spark aggregate
    that opens no file, and their frames are left out by an anti join on the
    path. The few paths are stored, so Spark knows that they are few.
    """
    # Folders are listed as a whole; a pattern for files would make every file a listing of its own.
    folders = f"{root}/data/chunk-*"
    reader = spark.read if schema is None else spark.read.schema(schema)
    frames = reader.option("pathGlobFilter", FRAME_FILES).parquet(folders)
    path = F.col("_metadata.file_path")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", FRAME_FILES).load(folders)
    lost = materialize(superseded_files(listed.select(path.alias("_path"))), "superseded")
    kept = frames.withColumn("_path", path).join(lost, "_path", "left_anti")
    return kept.select(
        *[F.col(f"`{c}`") for c in frames.columns if c != "episode_index"],
        F.regexp_extract("_path", FRAME_NAME, 2).cast("bigint").alias("episode_index"),
    )


def superseded_files(files: DataFrame) -> DataFrame:
    """Paths (``_path``) of all but one file of each episode: the one in its chunk of 1000 stays, else the first by name."""
    chunk, episode = (F.regexp_extract("_path", FRAME_NAME, k).try_cast("bigint") for k in (1, 2))
    named = files.select("_path", chunk.alias("chunk"), episode.alias("episode")).where("episode IS NOT NULL")
    in_place = F.col("chunk") == F.expr(f"episode DIV {DEFAULT_CHUNK}")
    ranked = F.struct((~in_place).cast("int"), "_path")
    best = named.groupBy("episode").agg(F.min_by("_path", ranked).alias("_best"), F.count(F.lit(1)).alias("_n"))
    doubled = best.where("_n > 1").select("episode", "_best")
    return named.join(doubled, "episode").where("_path <> _best").select("_path")


def scan_frames_v3(spark: SparkSession, root: str) -> DataFrame:
    """All shards; predicates on ``episode_index`` reach the row groups."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{root}/data")


# Ranges of episode indexes that a scan gets pushed down at most.
RANGES = 256


def slice_episodes(frames: DataFrame, wanted: Sequence[int] | DataFrame) -> DataFrame:
    """Frames of the wanted episodes: a list, or a table with ``episode_index`` of any size.

    A table is first covered by at most ``RANGES`` ranges, which reach the scan,
    so row groups outside all of them are not read; a semi join then decides.
    """
    if "episode_index" not in frames.columns:
        raise ValueError("frames have no episode_index column")
    if not isinstance(wanted, DataFrame):
        return frames.where(F.col("episode_index").isin(*wanted))
    ids = wanted.select(F.col("episode_index").cast("bigint").alias("episode_index")).where("episode_index IS NOT NULL")
    low, high = ids.agg(F.min("episode_index"), F.max("episode_index")).first()
    if low is None:
        return frames.where(F.lit(False))
    width = (high - low) // RANGES + 1
    part = F.expr(f"(episode_index - {low}L) DIV {width}L")
    # At most RANGES rows, however many episodes are wanted.
    ends = ids.groupBy(part).agg(F.min("episode_index").alias("lo"), F.max("episode_index").alias("hi")).collect()
    inside = F.lit(False)
    for lo, hi in joined_ranges(sorted((r["lo"], r["hi"]) for r in ends)):
        inside = inside | F.col("episode_index").between(lo, hi)
    return frames.where(inside).join(ids.distinct(), "episode_index", "left_semi")


def joined_ranges(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, with those that touch made one."""
    out: list[tuple[int, int]] = []
    for lo, hi in ranges:
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def empty_episodes(episodes: DataFrame, frames: DataFrame) -> DataFrame:
    """Catalogued episodes without a single frame."""
    return episodes.join(frames.select("episode_index").distinct(), "episode_index", "left_anti")


# ── metadata ─────────────────────────────────────────────────────────


def scan_info(spark: SparkSession, paths: str | Sequence[str], strict: bool = False) -> DataFrame:
    """``(path, info VARIANT, problem)`` of small JSON description files."""
    text = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("info")
    )
    kind = F.schema_of_variant("info")
    problem = F.when(F.col("info").isNull(), "not valid JSON").when(
        ~kind.startswith("OBJECT"), F.concat(F.lit("not a JSON object but "), kind)
    )
    out = text.withColumn("problem", problem)
    if not strict:
        return out
    return out.withColumn(
        "info",
        F.when(F.col("problem").isNull(), F.col("info")).otherwise(
            F.raise_error(F.concat_ws(": ", "path", "problem"))
        ),
    )


def info_features(info: DataFrame, strict: bool = False) -> DataFrame:
    """``(path, codebase_version, fps, robot_type, total_*, name, dtype)``."""
    v = F.col("info")
    version = F.try_variant_get(v, "$.codebase_version", "string")
    features = F.map_entries(F.try_variant_get(v, "$.features", "map<string,variant>"))
    return info.select(
        "path",
        (require_format(version) if strict else version).alias("codebase_version"),
        format_support(version).alias("support"),
        F.try_variant_get(v, "$.fps", "double").alias("fps"),
        F.try_variant_get(v, "$.robot_type", "string").alias("robot_type"),
        F.try_variant_get(v, "$.total_episodes", "bigint").alias("total_episodes"),
        F.try_variant_get(v, "$.total_frames", "bigint").alias("total_frames"),
        F.explode_outer(features).alias("f"),
    ).select(
        "*", F.col("f.key").alias("name"), F.try_variant_get("f.value", "$.dtype", "string").alias("dtype")
    ).drop("f")


def camera_keys(features: DataFrame, key: str = "path") -> DataFrame:
    """Camera columns: the ones declared as video, else those named as images."""
    declared = features.groupBy(key).agg(F.max(F.col("dtype") == "video").alias("_any"))
    return (
        features.join(declared, key)
        .where(
            F.when(F.coalesce("_any", F.lit(False)), F.col("dtype") == "video").otherwise(
                F.col("name").startswith(CAMERA_PREFIX)
            )
        )
        .drop("_any")
    )


def _integer(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string").try_cast("double").cast("bigint")


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Non-blank lines with their 0-based position in the file.

    A large file is read as several byte ranges. The range start orders the
    ranges, and ids grow within a range, so positions come from per-range counts
    and no file is read as a single value.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        stripped(F.col("value")).alias("line"),
    )
    return number_rows(lines.where(F.col("line") != ""), ["path"], ["block", "id"], out="pos", keep=["path", "line"])


def broken_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, pos, line)`` of lines that hold no JSON."""
    return numbered_lines(spark, paths).where(F.try_parse_json("line").isNull()).select("path", "pos", "line")


def scan_episodes_jsonl(spark: SparkSession, paths: str | Sequence[str], strict: bool = False) -> DataFrame:
    """``(path, pos, episode_index, length, row VARIANT)`` of episode lines.

    Lines that hold no JSON are no episodes: ``broken_lines`` has them, and
    ``strict`` fails on the first one.
    """
    rows = numbered_lines(spark, paths).withColumn("row", F.try_parse_json("line"))
    if strict:
        fail = F.raise_error(F.concat(F.lit("no JSON in line "), F.col("pos").cast("string"), F.lit(" of "), F.col("path")))
        rows = rows.withColumn("row", F.when(F.col("row").isNull(), fail.cast("variant")).otherwise(F.col("row")))
    rows = rows.where(F.col("row").isNotNull())
    v = F.col("row")

    def positive(path: str) -> Column:
        n = _integer(v, path)
        return F.when(n != 0, n)

    return rows.select(
        "path",
        "pos",
        F.coalesce(_integer(v, "$.episode_index"), F.col("pos")).alias("episode_index"),
        F.coalesce(positive("$.length"), positive("$.episode_length"), F.lit(0)).alias("length"),
        "row",
    )


def scan_episodes_v3(spark: SparkSession, root: str) -> DataFrame:
    """Episode rows of all metadata shards; sort them where an order is needed."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{root}/meta/episodes")


def _first_text(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in values], F.lit(""))


def tasks_from_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(task_index, task)``; later duplicates win, unusable rows are dropped."""
    rows = numbered_lines(spark, paths).withColumn("row", F.try_parse_json("line"))
    v = F.col("row")
    return latest_tasks(
        rows.select(
            _integer(v, "$.task_index").alias("task_index"),
            _first_text(
                F.try_variant_get(v, "$.task", "string"), F.try_variant_get(v, "$.description", "string")
            ).alias("task"),
            "pos",
        )
    )


def tasks_from_parquet(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    pos = F.col("_metadata.row_index")
    has = set(rows.columns)
    names = [c for c in ("task", "description", "__index_level_0__") if c in has]
    index = F.col("task_index").try_cast("bigint") if "task_index" in has else pos
    text = _first_text(*[F.col(c).cast("string") for c in names]) if names else F.lit("")
    return latest_tasks(rows.select(index.alias("task_index"), text.alias("task"), pos.alias("pos")))


def latest_tasks(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("task_index").isNotNull())
        .groupBy("task_index")
        .agg(F.max_by("task", "pos").alias("task"))
    )


def task_fields(episodes: DataFrame) -> DataFrame:
    """The three ways an episode line may name its tasks, from ``row``."""
    v = F.col("row")
    return episodes.select(
        "*",
        F.try_variant_get(v, "$.tasks", "array<string>").alias("tasks"),
        F.try_variant_get(v, "$.task", "string").alias("task"),
        _integer(v, "$.task_index").alias("task_index"),
    )


def with_tasks(episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """Episode task lists: a list, else one task, else the task table.

    ``episodes`` has ``tasks ARRAY``, ``task STRING`` and ``task_index``.
    """
    lookup = tasks.select("task_index", F.col("task").alias("_looked_up"))
    # Most rows may have no index, or all the same one.
    joined = salted_join(episodes, lookup, ["task_index"], row_hash(episodes), how="left")
    return joined.withColumn(
        "task_list",
        F.when(F.col("tasks").isNotNull(), F.col("tasks"))
        .when(F.length("task") > 0, F.array("task"))
        .when(F.col("_looked_up").isNotNull(), F.array("_looked_up"))
        .otherwise(F.array().cast("array<string>")),
    ).drop("_looked_up")


LOCATOR_PARTS = ("chunk_index", "file_index", "from_timestamp", "to_timestamp")


def video_locators(episodes: DataFrame, cameras: Sequence[str]) -> DataFrame:
    """One row per episode and camera whose four columns are all given."""

    def part(camera: str, name: str) -> Column:
        column = f"videos/{camera}/{name}"
        kind = "double" if name.endswith("timestamp") else "bigint"
        if column not in episodes.columns:
            return F.lit(None).cast(kind).alias(name)
        return F.col(f"`{column}`").try_cast(kind).alias(name)

    entries = [
        F.struct(F.lit(c).alias("camera"), *[part(c, p) for p in LOCATOR_PARTS]) for c in cameras
    ]
    long = episodes.select("episode_index", F.inline(F.array(*entries)))
    whole = F.lit(True)
    for p in LOCATOR_PARTS:
        whole = whole & F.col(p).isNotNull()
    return long.where(whole)


def dataset_summary(info: DataFrame, episodes: DataFrame, key: str = "path") -> DataFrame:
    """Totals per dataset: declared, or counted where the declaration is 0 or absent."""
    counted = episodes.groupBy(key).agg(
        F.count(F.lit(1)).alias("_episodes"), F.sum("length").alias("_frames")
    )

    def total(declared: str, found: str) -> Column:
        return F.coalesce(F.nullif(F.col(declared), F.lit(0).cast("bigint")), F.col(found), F.lit(0))

    joined = info.join(counted, key, "left")
    return joined.withColumn("total_episodes", total("total_episodes", "_episodes")).withColumn(
        "total_frames", total("total_frames", "_frames")
    ).drop("_episodes", "_frames")


def feature_text(features: DataFrame, key: str = "path", limit: int | None = None) -> DataFrame:
    """All features by name; with ``limit`` the first ones and how many more there are.

    Cameras and bookkeeping columns are not listed.
    """
    shown = features.where(
        ~F.col("name").startswith(CAMERA_PREFIX) & ~F.col("name").isin(*FRAME_BOOKKEEPING)
    )
    names = shown.groupBy(key).agg(F.sort_array(F.collect_list("name")).alias("_names"))
    if limit is None:
        return names.select(key, F.array_join("_names", ", ").alias("features"))
    more = F.size("_names") - limit
    return names.select(
        key,
        F.concat(
            F.array_join(F.slice("_names", 1, limit), ", "),
            F.when(more > 0, F.format_string(" (+%d more)", more)).otherwise(""),
        ).alias("features"),
    )


def dataset_report(summary: DataFrame, features: DataFrame, episodes: DataFrame, key: str = "path", short: bool = False) -> DataFrame:
    """Text lines per dataset; ``short`` names eight features and lists episodes of datasets of at most five."""
    cameras = camera_keys(features, key).groupBy(key).agg(
        F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("cameras")
    )
    told = episodes
    if short:
        told = episodes.join(summary.where("total_episodes <= 5").select(key), key)
    listed = (
        told
        .groupBy(key)
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("episode_index", "length", "task"))),
                lambda e: F.format_string(
                    "  ep %d: %d frames, task='%s'",
                    e["episode_index"],
                    e["length"],
                    F.coalesce(e["task"], F.lit("(no task)")),
                ),
            ).alias("eps")
        )
    )
    joined = (
        summary.join(cameras, key, "left")
        .join(feature_text(features, key, 8 if short else None), key, "left")
        .join(listed, key, "left")
    )
    head = F.format_string("%s  (%s, %s fps)", F.col(key).cast("string"), "codebase_version", F.col("fps").cast("string"))
    lines = F.array_compact(
        F.array(
            head,
            F.format_string("  episodes: %d, frames: %d", "total_episodes", "total_frames"),
            F.concat(F.lit("  cameras: "), F.col("cameras")),
            F.concat(F.lit("  features: "), F.col("features")),
        )
    )
    every = F.concat(lines, F.coalesce("eps", F.array().cast("array<string>")))
    return joined.select(key, F.posexplode(every).alias("line_no", "line"))
