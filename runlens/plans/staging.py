"""Files derived from the given tables, for queries that scan files.

Everything is written by executors below the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.plans import bindings as B
from runlens.session import partitions_by_size, shared_dir

_WRITTEN = "path STRING, rows BIGINT"


def _open(path: str):
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(inner)


def frames_by_file(frames: DataFrame, root: str) -> None:
    """One parquet file per episode. Rows stream through a task batch by batch."""

    names = frames.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        current, sink, writer, done = None, None, None, []
        for pdf in batches:
            pdf.columns = names
            for episode, part in pdf.groupby("episode_index", sort=True):
                table = pa.Table.from_pandas(part, preserve_index=False)
                if episode != current:
                    if writer is not None:
                        writer.close()
                        sink.close()
                    path = f"{root}/data/chunk-{episode // 1000:03d}/episode_{episode:06d}.parquet"
                    sink = _open(path)
                    writer = pq.ParquetWriter(sink, table.schema)
                    current = episode
                    done.append(path)
                writer.write_table(table)
        if writer is not None:
            writer.close()
            sink.close()
        if done:
            yield pd.DataFrame({"path": done, "rows": [0] * len(done)})

    sorted_frames = frames.repartition(*partitions_by_size(frames), "episode_index").sortWithinPartitions("episode_index", "frame_index")
    # Pandas functions cannot take column names with dots.
    sorted_frames = sorted_frames.toDF(*[f"c{i}" for i in range(len(names))])
    sorted_frames.mapInPandas(write, _WRITTEN).write.format("noop").mode("overwrite").save()


def archives(rows: DataFrame, root: str) -> None:
    """One NumPy archive per row ``(name, steps ARRAY<STRUCT<turn, n_chars>>)``."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import numpy as np

        for pdf in batches:
            sizes = []
            for name, steps in zip(pdf["name"], pdf["steps"], strict=True):
                turns = np.array([s["turn"] for s in steps], dtype="int64")
                chars = np.array([s["n_chars"] for s in steps], dtype="float32")
                buf = io.BytesIO()
                np.savez(
                    buf,
                    **{
                        "/talk/n_chars": chars.reshape(-1, 1),
                        "/talk/_t_ns": turns * 1_000_000_000,
                        "schema": np.array(1),
                        "/meta/labels": np.array([None] * len(turns), dtype=object),
                    },
                )
                with _open(f"{root}/{name}.npz") as out:
                    out.write(buf.getvalue())
                sizes.append(len(turns))
            yield pd.DataFrame({"path": pdf["name"], "rows": sizes})

    rows.mapInPandas(write, _WRITTEN).write.format("noop").mode("overwrite").save()


def text_files(rows: DataFrame, root: str, group: str, order: str) -> None:
    """One text file per group of whole numbers, lines in order; ``rows`` is (group, order, line).

    Files of a thousand groups share a folder: a folder for each file takes
    longer to make and to list than the file takes to write and to read.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, sink, done = None, None, []
        for pdf in batches:
            for key, part in pdf.groupby(group, sort=True):
                if key != current:
                    if sink is not None:
                        sink.close()
                    path = f"{root}/part-{key // 1000:03d}/{group}={key}.txt"
                    sink, current = _open(path), key
                    done.append(path)
                sink.write("".join(f"{line}\n" for line in part["line"]).encode())
        if sink is not None:
            sink.close()
        if done:
            yield pd.DataFrame({"path": done, "rows": [0] * len(done)})

    dealt = rows.repartition(*partitions_by_size(rows), group).sortWithinPartitions(group, order)
    dealt.select(group, "line").mapInPandas(write, _WRITTEN).write.format("noop").mode("overwrite").save()


def line_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as frames of a per-frame dataset, one episode per supplier."""
    steps = B.line_steps(spark, sf_dir, keep=(*B.LINE_VALUES, "l_linenumber"))
    state = F.array(F.col("l_quantity").cast("float"), F.col("l_discount").cast("float"))
    ragged = F.when(F.col("step") % 50 == 49, F.slice(state, 1, 1)).otherwise(state)
    last = F.col("l_tax").cast("float")
    return steps.select(
        F.col("episode_id").alias("episode_index"),
        F.col("step").alias("frame_index"),
        (F.col("step") / 10).cast("float").alias("timestamp"),
        state.alias("observation.state"),
        F.when(F.col("episode_id") % 2 == 0, ragged).otherwise(state).alias("observation.ragged"),
        F.col("l_linenumber").alias("observation.line"),
        F.col("l_returnflag").alias("observation.flag"),
        F.array(last, last, last).alias("action"),
        F.col("l_extendedprice").cast("float").alias("next.reward"),
    )


def fresh(spark: SparkSession, purpose: str) -> str:
    return shared_dir(spark, purpose)
