"""Reading tables and storing intermediate results in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this
    machine; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="runlens-llm-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: no lineage, no second evaluation."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text"):
    """The text, where a missing one counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def arrow_rows(make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]]):
    """A ``mapInArrow`` function whose state is built once in each task by ``make``."""

    def run(batches):
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    return run


def by_length(texts, chars: int):
    """Lists of whole texts of about ``chars`` characters together; a longer text stands alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def sized(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it was counted to hold at most ``rows`` narrow rows; else unmarked, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
