"""Clocks, frame rates, names and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frame rates used when a recording declares none.
DEFAULT_FPS = 30.0
FALLBACK_MESSAGE_FPS = 10.0
NS = 1_000_000_000


def seconds_to_ns(ts: Column) -> Column:
    """Seconds (float32 widened) to whole nanoseconds, truncated."""
    return (ts.cast("double") * F.lit(float(NS))).cast("bigint")


def synthetic_ns(step: Column, fps: Column) -> Column:
    """Clock of a recording that stores none."""
    tick = (F.lit(float(NS)) / fps.cast("double")).cast("bigint")
    return F.when(fps > 0, step * tick).otherwise(F.lit(0).cast("bigint"))


def resolve_fps(user: Column, file: Column) -> Column:
    """``struct(fps, assumed)``: caller, then file, then the default."""
    pick = F.when(user > 0, user.cast("double")).when(file > 0, file.cast("double"))
    return F.struct(
        F.coalesce(pick, F.lit(DEFAULT_FPS)).alias("fps"), pick.isNull().alias("assumed")
    )


def duration_s(length: Column, fps: Column, empty_is_null: bool = False) -> Column:
    ok = fps > 0
    if empty_is_null:
        ok = ok & (length > 0)
    return F.when(ok, length / fps)


def fps_from_median(median_ns: Column) -> Column:
    """Two-decimal rate from the median gap between messages."""
    return F.coalesce(
        F.when(median_ns > 0, F.round(F.lit(float(NS)) / median_ns, 2)),
        F.lit(FALLBACK_MESSAGE_FPS),
    )


def clip_window(from_s: Column, to_s: Column, fps: Column) -> Column:
    """Frame range [start, end) of a clip; at least one frame."""
    start = F.greatest(F.lit(0).cast("bigint"), F.bround(from_s * fps, 0).cast("bigint"))
    end = F.bround(to_s * fps, 0).cast("bigint")
    return F.struct(start.alias("start"), F.greatest(end, start + 1).alias("end"))


def clamp_failure_time(t: Column, duration: Column) -> Column:
    return F.when(
        t.isNotNull(),
        F.when(duration.isNull(), F.greatest(t, F.lit(0.0))).otherwise(
            F.least(F.greatest(t, F.lit(0.0)), duration)
        ),
    )


def episode_name(template: Column, source: Column, index: Column) -> Column:
    """Name from a template; a malformed template gives the default name.

    Templates may use ``{episode_index}`` and ``{repo_id}``.
    """
    default = F.concat(source, F.lit(" #"), index.cast("string"))
    plain = F.replace(F.replace(template, F.lit("{episode_index}"), F.lit("")), F.lit("{repo_id}"), F.lit(""))
    filled = F.replace(
        F.replace(template, F.lit("{episode_index}"), index.cast("string")), F.lit("{repo_id}"), source
    )
    return F.when(template.isNull() | plain.rlike("[{}]"), default).otherwise(filled)


def recording_name(path: Column) -> Column:
    return F.concat(F.substring_index(path, "/", -1), F.lit(" (ros2 bag)"))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")


def replay_name(run_name: Column, version: Column, baseline_id: Column, chars: int | None = None) -> Column:
    """Name of a replayed episode; ``chars`` shortens the baseline id, which then need not be unique."""
    return F.concat(
        F.coalesce(F.nullif(run_name, F.lit("")), F.concat(F.lit("replay "), version)),
        F.lit(" · "),
        baseline_id if chars is None else F.substring(baseline_id, 1, chars),
    )


def frame_file(index: Column, chunk_size: int = 1000) -> Column:
    """Relative path of the frame file of one episode."""
    return F.format_string(
        "data/chunk-%03d/episode_%06d.parquet", F.floor(index / chunk_size).cast("bigint"), index
    )


def video_file(index: Column, camera: Column, chunk_size: int = 1000) -> Column:
    return F.format_string(
        "videos/%s/chunk-%03d/episode_%06d.mp4",
        camera,
        F.floor(index / chunk_size).cast("bigint"),
        index,
    )


def shard_file(chunk_index: Column, file_index: Column) -> Column:
    return F.format_string("data/chunk-%03d/file-%03d.parquet", chunk_index, file_index)


def demo_order(key: Column) -> Column:
    """Sort key that puts ``demo_10`` after ``demo_2``."""
    number = F.regexp_extract(key, r"_([0-9]+)$", 1).try_cast("bigint")
    return F.struct(F.coalesce(number, F.lit(0).cast("bigint")).alias("n"), key.alias("key"))


def traceparent(trace_hex: Column, span_hex: Column, flags: Column) -> Column:
    """W3C trace parent from hex ids; all-zero ids give NULL."""
    trace = F.lpad(F.lower(trace_hex), 32, "0")
    span = F.lpad(F.lower(span_hex), 16, "0")
    live = ~trace.rlike("^0+$") & ~span.rlike("^0+$")
    flag = F.lpad(F.lower(F.hex(flags.cast("bigint").bitwiseAND(255))), 2, "0")
    return F.when(
        live,
        F.struct(
            trace.alias("trace_id"),
            span.alias("span_id"),
            F.concat_ws("-", F.lit("00"), trace, span, flag).alias("traceparent"),
        ),
    )


def fixed_text(value: Column, digits: int, signed: bool = False) -> Column:
    """A number with so many decimals, rounded by its exact binary value, ties to the even digit.

    ``format_string`` rounds the shortest decimal text of a number and takes ties up.
    """
    number = value.cast("double")
    shape = "0." + "0" * digits
    text = F.call_function("format_number", number, F.lit(f"+{shape};-{shape}" if signed else shape))
    finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
    return F.when(finite, text).otherwise(F.format_string(f"%{'+' if signed else ''}.{digits}f", number))


def number_text(value: Column, signed: bool = False) -> Column:
    """Three decimals, an optional plus sign, ``-`` for NULL."""
    return F.when(value.isNull(), F.lit("-")).otherwise(fixed_text(value, 3, signed))


def flag_text(value: Column) -> Column:
    return F.when(value.isNull(), "-").when(value, "yes").otherwise("no")


def stripped(text: Column) -> Column:
    """``text`` without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
