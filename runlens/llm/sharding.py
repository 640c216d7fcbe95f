"""Jump consistent hashing: stable keys to shards, without a ring table.

The shard of a row depends on its key and the number of shards alone. One more
shard takes rows only into itself, about one row in ``shards + 1``. Rows get
gapless slots within their shard from counts per (shard, task), so no shard is
ever gathered in one task.

Defined cases: a missing key is a key of its own, a missing text has size 8 and
the checksum of the empty text, equal rows share a shard and get slots of their
own, and an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm.common import stored, table, whole_text
from runlens.llm.registry import query

MISSING_KEY = 0x9E3779B97F4A7C15


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key by the published jump algorithm, all keys at a time."""
    state = keys.astype(np.uint64).copy()
    shard = np.full(len(state), -1, np.int64)
    ahead = np.zeros(len(state), np.int64)
    while (live := np.flatnonzero(ahead < shards)).size:
        shard[live] = ahead[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[live] = ((shard[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
    return shard.astype(np.int32)


def mixed(keys: np.ndarray) -> np.ndarray:
    """Spread neighbouring integer keys over all 64 bits."""
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def assign(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """``rows`` with shard, grown_shard (one shard more) and slot; ``key`` is an integer column.

    Columns of ``rows`` named like an added one are replaced.
    """
    added = ("shard", "grown_shard", "slot", "_task", "_local")
    rows = rows.drop(*[c for c in added if c != key])
    schema = rows.withColumns(
        {"shard": F.lit(0), "grown_shard": F.lit(0), "_task": F.lit(0), "_local": F.lit(0).cast("long")}
    ).schema

    def deal(batches):
        seen: dict[int, int] = defaultdict(int)
        task = TaskContext.get().partitionId()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(key)).cast(pa.int64())
            keys = mixed(column.fill_null(0).to_numpy(zero_copy_only=False))
            keys[column.is_null().to_numpy(zero_copy_only=False)] = MISSING_KEY
            shard, grown = jump_hash(keys, shards), jump_hash(keys, shards + 1)
            local = np.empty(len(keys), np.int64)
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                local[at] = seen[s] + np.arange(len(at))
                seen[s] += len(at)
            for name, values in (("shard", shard), ("grown_shard", grown)):
                batch = batch.append_column(name, pa.array(values, pa.int32()))
            batch = batch.append_column("_task", pa.array(np.full(len(keys), task, np.int32)))
            yield batch.append_column("_local", pa.array(local))

    dealt = stored(rows.mapInArrow(deal, schema), "sharding")
    counts = dealt.groupBy("shard", "_task").count()
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return (
        dealt.join(starts, ["shard", "_task"])
        .withColumn("slot", F.col("_start") + F.col("_local"))
        .drop("_task", "_local", "_start")
    )


@query("op6_jump_hash")
def op6_jump_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = whole_text()
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return assign(rows, "doc_id", 24).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
