"""NumPy archives and CSV action traces as samples."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.scalars import stripped
from runlens.session import materialize

_ROWS = 50_000
ARCHIVE_ROWS = "path STRING, key STRING, step BIGINT, t_ns BIGINT, value ARRAY<DOUBLE>, shape ARRAY<INT>, reason STRING"


def _archive_batches(path: str, content: bytes) -> Iterator[pd.DataFrame]:
    """Rows of one archive in bounded batches; bad arrays give one reason row."""
    import numpy as np

    def note(key: str, reason: str) -> pd.DataFrame:
        return pd.DataFrame(
            {"path": [path], "key": [key], "step": [None], "t_ns": [None], "value": [None], "shape": [None], "reason": [reason]}
        ).astype({"step": "Int64", "t_ns": "Int64"})

    try:
        archive = np.load(io.BytesIO(content), allow_pickle=False)
    except Exception as exc:  # noqa: BLE001 - an unreadable file is one note
        yield note("*", f"unreadable: {exc}")
        return
    for key in archive.files:
        try:
            arr = archive[key]
        except ValueError as exc:
            yield note(key, f"refused: {exc}")
            continue
        if arr.ndim == 0:
            yield note(key, "scalar array has no steps")
            continue
        if not (np.issubdtype(arr.dtype, np.number) or arr.dtype == bool):
            yield note(key, f"not numeric: {arr.dtype}")
            continue
        clock = None
        clock_key = f"{key.rsplit('/', 1)[0]}/_t_ns" if "/" in key else "_t_ns"
        if clock_key in archive.files and clock_key != key:
            stamps = archive[clock_key]
            clock = stamps if len(stamps) == len(arr) else None
        flat = arr.reshape(len(arr), -1).astype("float64")
        for start in range(0, len(arr), _ROWS):
            part = flat[start : start + _ROWS]
            n = len(part)
            yield pd.DataFrame(
                {
                    "path": pd.Series([path] * n, dtype=object),
                    "key": pd.Series([key] * n, dtype=object),
                    "step": pd.array(range(start, start + n), dtype="Int64"),
                    "t_ns": pd.array(
                        clock[start : start + n].tolist() if clock is not None else [None] * n, dtype="Int64"
                    ),
                    "value": list(part),
                    "shape": [list(arr.shape[1:])] * n,
                    "reason": pd.Series([None] * n, dtype=object),
                }
            )


def scan_npz(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(samples, issues)`` of NumPy archives, one file per task slot.

    Pickled object arrays are refused, since loading them would run code.
    """

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                yield from _archive_batches(path, content)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.option("pathGlobFilter", "*.npz").load(paths).select("path", "content")
    # Stored, so that samples and issues do not open every archive each.
    rows = materialize(files.mapInPandas(load, ARCHIVE_ROWS), "archives")
    samples = rows.where(F.col("reason").isNull()).drop("reason")
    issues = rows.where(F.col("reason").isNotNull()).select(
        F.col("path").alias("recording_id"), F.col("key").alias("item"), "reason"
    )
    return samples, issues


def scan_csv_actions(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], time: str = "t_s"
) -> DataFrame:
    """Action traces with one column per component, as long samples."""
    schema = f"{time} DOUBLE, " + ", ".join(f"{c} DOUBLE" for c in columns)
    rows = spark.read.schema(schema).option("header", True).csv(paths)
    entries = [
        F.struct(F.lit(f"{c}/value").alias("key"), F.array(F.col(c).cast("float")).alias("value")) for c in columns
    ]
    return rows.select(
        F.col("_metadata.file_path").alias("path"),
        (F.col(time) * 1e9).cast("bigint").alias("t_ns"),
        F.inline(F.array(*entries)),
    )


def baseline_ids(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Ids of a list file: trimmed lines without blanks and ``#`` comments."""
    line = stripped(F.col("value"))
    return (
        spark.read.text(paths)
        .select(line.alias("baseline_episode_id"))
        .where((F.col("baseline_episode_id") != "") & ~F.col("baseline_episode_id").startswith("#"))
    )
