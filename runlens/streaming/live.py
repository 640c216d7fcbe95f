"""Recordings as they arrive.

Running results live in Spark's state store and are read from there
(``held_state``): one row for each key, the newest committed batch, nothing
re-read. Rows that are final when they appear (closed recordings, late rows) are
appended. What a recording holds when it is closed is decided in event time: an
open recording keeps the messages that the watermark has not passed, so how
messages fall into batches makes no difference.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from runlens.functions.outcome import merge_metadata
from runlens.operators.catalog import exit_status

BatchWriter = Callable[[DataFrame, int], None]


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New files of a folder, in order of their times; all that are there in one batch unless a number is given."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def ingest(stream: DataFrame, known: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Messages of the wanted topics; an unknown topic fails before the start.

    ``known`` is a batch table of topics; only the wanted ones are looked up.
    """
    if not topics:
        raise ValueError("name at least one topic")
    found = {r["topic"] for r in known.where(F.col("topic").isin(*topics)).select("topic").distinct().collect()}
    missing = [t for t in topics if t not in found]
    if missing:
        raise ValueError(f"unknown topics {missing}")
    return stream.where(F.col("topic").isin(*topics))


def topic_counts(stream: DataFrame) -> DataFrame:
    """Running message count per recording and topic; combined before the shuffle."""
    return stream.groupBy("recording_id", "topic").agg(F.count(F.lit(1)).alias("n"))


def closed_sessions(stream: DataFrame, gap: str, delay: str) -> DataFrame:
    """One row per recording session, once no message can extend it any more.

    Sessions exist only where a message does, so an empty recording gives no row.
    Messages are merged into sessions before the shuffle, so a recording with
    very many messages sends on few rows.
    """
    stream.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    return (
        stream.withWatermark("ts", delay)
        .groupBy("recording_id", F.session_window("ts", gap).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("message_count"),
            F.min("t_ns").alias("first_ns"),
            F.max("t_ns").alias("last_ns"),
        )
        .select(
            "recording_id",
            "message_count",
            "first_ns",
            "last_ns",
            ((F.col("last_ns") - F.col("first_ns")) / 1e9).alias("duration_s"),
        )
    )


def unique_messages(stream: DataFrame, keys: Sequence[str], delay: str) -> DataFrame:
    """Messages once each; repeats and rows behind the watermark are dropped."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def latest_results(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last write for each key by ``order``; a write that is pushed again changes nothing."""
    rest = [c for c in stream.columns if c not in keys]
    return stream.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))


# ── running ──────────────────────────────────────────────────────────


def drain(stream: DataFrame, write: BatchWriter | None, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything available now and stop; without a writer, only the state is kept."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.foreachBatch(write) if write else writer.format("noop")).start()
    query.awaitTermination()
    return query


def append_rows(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append final rows to the folder ``out``; its commit log makes each batch count once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def held_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Key and value columns of a query's state after its newest committed batch."""
    return spark.read.format("statestore").load(checkpoint)


def held_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What ``topic_counts`` has counted so far."""
    return held_state(spark, checkpoint).select("key.*", F.col("value.count").alias("n"))


def held_results(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What ``latest_results`` holds: one row for each key."""
    return held_state(spark, checkpoint).select("key.*", "value.valueWithExtremumOrdering.*")


def batch_folder(out: str, name: str, batch_id: int) -> str:
    return f"{out}/{name}/batch={batch_id}"


def folder_writer(out: str, name: str) -> BatchWriter:
    """Each batch's rows in a folder of their own, which a retry overwrites: an append log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(out, name, batch_id))

    return write


def stored(spark: SparkSession, out: str, name: str, schema: T.StructType | str) -> DataFrame:
    """Rows of all batches with their ``batch``."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*struct.fields, T.StructField("batch", T.LongType())])
    if not _exists(spark, f"{out}/{name}"):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{out}/{name}").parquet(f"{out}/{name}")


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


# ── late rows ────────────────────────────────────────────────────────

CLOCK = "latest_ms BIGINT"


def late_splitter(out: str, delay_ms: int) -> BatchWriter:
    """Rows of each batch below ``out``/rows, parted by ``late``: at or behind the batch's watermark.

    The watermark of a batch is the latest ``ts`` of the batches before it, in
    whole milliseconds, less the delay, as Spark's own is. The clock is one row,
    written with each batch and read by the next one alone; a batch that is
    tried again reads what it read at first.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clock = None
        if batch_id > 0 and _exists(spark, batch_folder(out, "clock", batch_id - 1)):
            clock = spark.read.schema(CLOCK).parquet(batch_folder(out, "clock", batch_id - 1)).first()["latest_ms"]
        time = F.unix_millis("ts")
        late = F.lit(False) if clock is None else F.unix_micros("ts") <= (clock - delay_ms) * 1000
        seen = Observation()
        marked = batch.withColumn("late", F.coalesce(late, F.lit(False))).observe(seen, F.max(time).alias("latest"))
        marked.write.mode("overwrite").partitionBy("late").parquet(batch_folder(out, "rows", batch_id))
        latest = max((x for x in (clock, seen.get["latest"]) if x is not None), default=None)
        spark.createDataFrame([(latest,)], CLOCK).coalesce(1).write.mode("overwrite").parquet(batch_folder(out, "clock", batch_id))

    return write


def split_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """All rows that a ``late_splitter`` wrote, with ``batch`` and ``late``."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("late", T.BooleanType())])
    return spark.read.schema(full).option("basePath", f"{out}/rows").parquet(f"{out}/rows")


# ── explicit stop markers ────────────────────────────────────────────

CLOSED = (
    "recording_id BIGINT, salt INT, n BIGINT, late BIGINT, first_ns BIGINT, last_ns BIGINT, "
    "stop_ns BIGINT, exc_type STRING, exc_message STRING"
)
NS_PER_MS = 1_000_000
# Recordings are dealt over so many keys of the state store (for each salt); a key holds all of its recordings as arrays.
BUCKETS = 512
NEVER, UNSEEN = np.iinfo(np.int64).max, np.iinfo(np.int64).min
# What a key holds of each recording: its first stop, what was counted before the watermark; then the times beyond it.
_START = {
    "closed": False, "stop_ns": NEVER, "stop_seq": NEVER, "exc_type": None, "exc_message": None,
    "n": 0, "late": 0, "first_ns": NEVER, "last_ns": UNSEEN,
}
_KINDS = {"closed": bool, "exc_type": object, "exc_message": object}


class Closing(StatefulProcessor):
    """Closes recordings once the watermark passes their first stop; later messages are counted as late.

    A key is a bucket of recordings: a call costs as much for one recording as
    for a thousand, and the number of calls does not grow with the recordings.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("recordings", "held BINARY")

    def _load(self) -> dict:
        row = self.held.get()
        if row is not None:
            return pickle.loads(row[0])
        state = {name: np.zeros(0, _KINDS.get(name, np.int64)) for name in _START}
        return state | {"id": np.zeros(0, np.int64), "who": np.zeros(0, np.int64), "at": np.zeros(0, np.int64), "timer": None}

    def _known(self, state: dict, ids: np.ndarray) -> None:
        """Make room for recordings that were not met before; ids stay sorted."""
        every = np.union1d(state["id"], ids)
        if len(every) == len(state["id"]):
            return
        place = np.searchsorted(every, state["id"])
        for name, start in _START.items():
            wider = np.full(len(every), start, _KINDS.get(name, np.int64))
            wider[place] = state[name]
            state[name] = wider
        state["who"] = place[state["who"]] if len(state["who"]) else state["who"]
        state["id"] = every

    def _stopped(self, state: dict, stops: pd.DataFrame) -> None:
        """Take over the first stops of open recordings."""
        first = stops.sort_values(["recording_id", "t_ns", "seq"]).drop_duplicates("recording_id")
        place = np.searchsorted(state["id"], first["recording_id"].to_numpy(np.int64))
        at, seq = first["t_ns"].to_numpy(np.int64), first["seq"].to_numpy(np.int64)
        held_at, held_seq = state["stop_ns"][place], state["stop_seq"][place]
        earlier = ~state["closed"][place] & ((at < held_at) | ((at == held_at) & (seq < held_seq)))
        place = place[earlier]
        state["stop_ns"][place], state["stop_seq"][place] = at[earlier], seq[earlier]
        for name in ("exc_type", "exc_message"):
            text = first[name].astype(object)
            state[name][place] = text.where(text.notna(), None).to_numpy()[earlier]

    def _settle(self, key, state: dict, watermark: int):
        """Fold what the watermark has passed; rows to emit."""
        who, at, stop = state["who"], state["at"], state["stop_ns"]
        was_closed = state["closed"].copy()
        due = ~was_closed & (stop != NEVER) & (stop // NS_PER_MS <= watermark)
        # Behind its recording's first stop a message is late, even if an earlier stop is still to come.
        late = was_closed[who] | (at > stop[who])
        counted = ~late & (due[who] | (at // NS_PER_MS <= watermark))
        size = len(state["id"])
        state["late"] += np.bincount(who[late], minlength=size)
        state["n"] += np.bincount(who[counted], minlength=size)
        np.minimum.at(state["first_ns"], who[counted], at[counted])
        np.maximum.at(state["last_ns"], who[counted], at[counted])
        stay = ~late & ~counted
        state["who"], state["at"] = who[stay], at[stay]
        state["closed"] |= due
        out = np.flatnonzero(due | (was_closed & (state["late"] > 0)))
        rows = {name: state[name][out] for name in ("n", "late", "first_ns", "last_ns", "stop_ns", "exc_type", "exc_message")}
        rows["recording_id"] = state["id"][out]
        state["n"][out] = state["late"][out] = 0
        ahead = stop[~state["closed"] & (stop != NEVER)]
        ahead = ahead.min() if len(ahead) else state["at"].max(initial=UNSEEN)
        timer = None if ahead == UNSEEN else max(int(ahead) // NS_PER_MS, watermark + 1)
        if timer != state["timer"]:
            # One that has expired is taken away by Spark.
            if state["timer"] is not None and state["timer"] > watermark:
                self.handle.deleteTimer(state["timer"])
            if timer is not None:
                self.handle.registerTimer(timer)
            state["timer"] = timer
        self.held.update((pickle.dumps(state, pickle.HIGHEST_PROTOCOL),))
        if len(out):
            frame = pd.DataFrame(rows).assign(salt=key[1])
            frame["recording_id"] = frame["recording_id"].astype("Int64").mask(np.full(len(out), key[0] < 0))
            for name, nothing in (("first_ns", NEVER), ("last_ns", UNSEEN)):
                frame[name] = frame[name].astype("Int64").mask(rows[name] == nothing)
            whole = ["n", "late", "stop_ns"]
            yield frame.astype(dict.fromkeys(whole, "Int64") | {"salt": "int32"})[[part.split()[0] for part in CLOSED.split(", ")]]

    def handleInputRows(self, key, rows, timerValues):
        state = self._load()
        who, at, stops = [], [], []
        for frame in rows:
            said = frame[frame["is_stop"].notna()]
            is_stop = said["is_stop"].to_numpy(bool)
            stops.append(said[is_stop])
            who.append(said["recording_id"].to_numpy(np.int64)[~is_stop])
            at.append(said["t_ns"].to_numpy(np.int64)[~is_stop])
        stops = pd.concat([f for f in stops if len(f)]) if any(map(len, stops)) else None
        ids = np.concatenate(who)
        self._known(state, ids if stops is None else np.concatenate([ids, stops["recording_id"].to_numpy(np.int64)]))
        state["who"] = np.concatenate([state["who"], np.searchsorted(state["id"], ids)])
        state["at"] = np.concatenate([state["at"], *at])
        if stops is not None:
            self._stopped(state, stops)
        yield from self._settle(key, state, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._settle(key, self._load(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def closed_recordings(stream: DataFrame, delay: str, salts: int = 4, buckets: int = BUCKETS) -> DataFrame:
    """``CLOSED`` rows of recordings whose first stop marker the watermark has passed, and of late messages after that.

    ``stream`` has recording_id, t_ns, seq, is_stop, exc_type and exc_message; a
    row whose ``is_stop`` is missing only moves the clock. Recordings are dealt
    over ``buckets``; a key of the state holds those of one. Messages of a
    recording are dealt over ``salts`` keys, its stop goes to each, so a
    recording with very many messages is counted by several tasks. Both numbers
    stay as they are for the life of a checkpoint.
    """
    spark = stream.sparkSession
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    one = F.array(F.pmod(F.xxhash64("seq"), F.lit(salts)).cast("int"))
    # A missing id has a bucket of its own and passes as 0, so that no id becomes a floating number on its way.
    bucket = F.when(F.col("recording_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("recording_id"), F.lit(buckets)).cast("int"))
    rows = (
        stream.withColumn("ts", F.timestamp_micros(F.expr("t_ns DIV 1000")))
        .withWatermark("ts", delay)
        .withColumn("salt", F.explode(F.when(F.col("is_stop"), every).otherwise(one)))
        .withColumn("bucket", bucket)
        .withColumn("recording_id", F.coalesce("recording_id", F.lit(0).cast("bigint")))
        .select("bucket", "salt", "recording_id", "t_ns", "seq", "is_stop", "exc_type", "exc_message", "ts")
    )
    return rows.groupBy("bucket", "salt").transformWithStateInPandas(
        Closing(), CLOSED, outputMode="append", timeMode="EventTime"
    )


def finalized(closed: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """Closed recordings with at least one message, one row each, from the appended ``CLOSED`` rows."""
    ended = (
        closed.groupBy("recording_id")
        .agg(
            F.sum("n").alias("message_count"),
            F.sum("late").alias("late_count"),
            ((F.max("last_ns") - F.min("first_ns")) / 1e9).alias("duration_s"),
            F.max("exc_type").alias("exc_type"),
            F.max("exc_message").alias("exc_message"),
        )
        .where("message_count > 0")
    )
    ended = ended.withColumn("_x", exit_status(F.col("exc_type"), F.col("exc_message")))
    made = F.map_filter(
        F.create_map(
            F.lit("mode"), F.lit("live"), F.lit("failure_reason"), F.col("_x.failure_reason")
        ),
        lambda k, v: v.isNotNull(),
    )
    if given is not None:
        ended = ended.join(given.withColumnRenamed("metadata", "_given"), "recording_id", "left")
        made = merge_metadata(made, F.col("_given"))
    return ended.select(
        "recording_id",
        F.col("_x.status").alias("status"),
        "message_count",
        "late_count",
        "duration_s",
        made.alias("metadata"),
    )
