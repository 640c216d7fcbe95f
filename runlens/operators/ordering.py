"""Positions inside ordered groups, safe for groups of any size.

A window over a group sends the whole group through one task. Here rows are
dealt out by ranges of group and order together, so a hot group covers several
partitions, and each partition is walked once in order. Only a partition's
first group can have begun before it: what is carried into it (rows so far, the
last value) comes from one summary row for each partition. The wide rows are
shuffled once and stored, because ranges are drawn anew whenever a plan runs.

Any sortable type may be a group or an order column. Neighbouring groups are
told apart by a 64-bit hash. Rows that tie in all order columns are ordered by a
hash of the whole row; only rows equal in every column share one place, and
those stay together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.session import materialize, partitions_by_size

# Working columns of a dealt table: group, partition, number of the group in it, place in the group there.
WORKING = ("_group", "_part", "_run", "_at")


def _walker(value: str | None, running: Sequence[str]):
    """Adds partition, run and place in the run to sorted batches, and ``value`` of the row before in the same run.

    Columns of ``running`` become their exclusive or over the run so far.
    """

    def walk(batches):
        part = TaskContext.get().partitionId()
        last, run, filled, before = None, -1, 0, None
        bits = dict.fromkeys(running, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            group = batch.column(batch.schema.get_field_index("_group")).to_numpy()
            new = np.concatenate(([last is None or group[0] != last], group[1:] != group[:-1]))
            begins = np.flatnonzero(new)
            nth = np.searchsorted(begins, np.arange(n), "right")
            # Where each run began; the one at hand began before the batch.
            at = np.arange(n) - np.concatenate(([-filled], begins))[nth]
            runs = run + nth
            added = {"_part": pa.array(np.full(n, part, np.int32)), "_run": pa.array(runs), "_at": pa.array(at)}
            if value is not None:
                column = batch.column(batch.schema.get_field_index(value))
                held = column if before is None else pa.concat_arrays([before, column])
                place = np.arange(n) - (before is None)
                added["_before"] = held.take(pa.array(place, mask=new))
                before = column.slice(n - 1)
            for name in running:
                place = batch.schema.get_field_index(name)
                sums = np.bitwise_xor.accumulate(np.concatenate(([bits[name]], batch.column(place).to_numpy())))
                # What lay before a run is taken out again; nothing for the run at hand.
                sums = sums[1:] ^ np.concatenate(([0], sums[begins]))[nth]
                bits[name] = int(sums[-1])
                batch = batch.set_column(place, batch.schema.field(place), pa.array(sums))
            last, run, filled = group[-1], int(runs[-1]), int(at[-1]) + 1
            for name, column in added.items():
                batch = batch.append_column(name, column)
            yield batch

    return walk


def _ending(batches):
    """Adds to walked batches whether a row is the last of its group; NULL in a partition's last row, which cannot tell.

    A batch is held back until the next one has come.
    """
    held, ends, last = None, None, None
    for batch in batches:
        group = batch.column(batch.schema.get_field_index("_group")).to_numpy()
        if held is not None:
            yield held.append_column("_ends", pa.array([*ends, group[0] != last], pa.bool_()))
        held, ends, last = batch, group[1:] != group[:-1], group[-1]
    if held is not None:
        yield held.append_column("_ends", pa.array([*ends, None], pa.bool_()))


def deal_in_order(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str | None = None, running: Sequence[str] = (),
    keep: Sequence[str] | None = None, ends: bool = False,
) -> DataFrame:
    """``df`` stored in order over partitions of even size, with the ``WORKING`` columns.

    ``value`` names a column whose value one row earlier in the run becomes
    ``_before``; long columns of ``running`` become their exclusive or over the
    run so far. With ``keep`` only these columns are stored; the others decide
    the order and go no further. ``ends`` adds ``_ends``: whether the group ends
    with the row, NULL in the last row of a partition.
    """
    by = [F.col(c).asc_nulls_first() for c in dict.fromkeys((*group, *order))]
    # Rows that tie in every column are equal, so a hash, which does not compress, is shuffled only for other columns.
    if not set(df.columns) <= {*group, *order}:
        df = df.withColumn("_tie", row_hash(df))
        by.append(F.col("_tie"))
    dealt = df.repartitionByRange(*partitions_by_size(df), *by).sortWithinPartitions(*by).drop("_tie")
    if keep is not None:
        dealt = dealt.select(*keep, *[c for c in group if c not in keep])
    dealt = dealt.withColumn("_group", F.xxhash64(*group))
    if keep is not None:
        dealt = dealt.select(*keep, "_group")
    added = {"_part": F.lit(0), "_run": F.lit(0).cast("long"), "_at": F.lit(0).cast("long")}
    if value is not None:
        added["_before"] = F.when(F.lit(False), F.col(value))
    if ends:
        added["_ends"] = F.lit(None).cast("boolean")
    walk = _walker(value, tuple(running))
    steps = (lambda batches: _ending(walk(batches))) if ends else walk
    return materialize(dealt.mapInArrow(steps, dealt.withColumns(added).schema), "ordered")


def carried(dealt: DataFrame, tail: dict[str, Column], start: dict, step: Callable[[dict, dict], dict]) -> DataFrame:
    """One row for each partition: ``_part``, what is carried into its first group, and ``_out`` if its last one goes on.

    ``tail`` are aggregates over the rows of a partition's last group. ``step``
    adds a partition's own tail to what came before it in the same group. The
    driver holds one row of a few values for each partition.
    """
    end = dealt.groupBy("_part").agg(F.max("_run").alias("_last"), F.max(F.when(F.col("_run") == 0, F.col("_group"))).alias("_first"))
    last = dealt.join(F.broadcast(end.select("_part", "_last")), "_part").where("_run = _last")
    tails = last.groupBy("_part").agg(F.first("_group").alias("_group"), *[c.alias(k) for k, c in tail.items()])
    parts = end.join(tails, "_part").collect()
    rows, before, held = [], None, dict(start)
    for p in sorted(parts, key=lambda r: r["_part"]):
        goes_on = p["_first"] == before
        if goes_on:
            rows[-1][1] = True
        rows.append([p["_part"], False, *(held if goes_on else start).values()])
        own = {k: p[k] for k in tail}
        held = step(held if goes_on and p["_last"] == 0 else dict(start), own)
        before = p["_group"]
    kinds = tails.select(*tail).schema
    known = [T.StructField("_part", T.IntegerType()), T.StructField("_out", T.BooleanType())]
    schema = T.StructType(known + [T.StructField(f"_in_{f.name}", f.dataType) for f in kinds.fields])
    return dealt.sparkSession.createDataFrame(rows, schema)


def _given(dealt: DataFrame, into: DataFrame) -> DataFrame:
    # One row for each partition at most, so the broadcast is bounded.
    return dealt.join(F.broadcast(into), "_part", "left")


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "step", keep: Sequence[str] | None = None,
    last: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row of its group as ``out``; with ``keep`` to these columns alone.

    ``last`` names a further column: whether the row is the last one of its group.
    """
    dealt = deal_in_order(df, group, order, keep=keep, ends=last is not None)
    into = carried(dealt, {"n": F.count(F.lit(1))}, {"n": 0}, lambda a, b: {"n": a["n"] + b["n"]})
    offset = F.when(F.col("_run") == 0, F.coalesce("_in_n", F.lit(0))).otherwise(0)
    numbered = _given(dealt, into).withColumn("_position", F.col("_at") + offset)
    if last is not None:
        numbered = numbered.withColumn(last, F.coalesce("_ends", ~F.col("_out")))
    return numbered.drop(*WORKING, "_ends", "_out", "_in_n").drop(out).withColumnRenamed("_position", out)


def previous_value(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``value`` of the row before, in the order given, as ``out``."""
    dealt = deal_in_order(df, group, order, value)
    into = carried(dealt, {"v": F.max_by(value, "_at")}, {"v": None}, lambda _, b: b)
    came = F.when((F.col("_run") == 0) & (F.col("_at") == 0), F.col("_in_v")).otherwise(F.col("_before"))
    found = _given(dealt, into).withColumn("_came", came)
    return found.drop(*WORKING, "_before", "_out", "_in_v").drop(out).withColumnRenamed("_came", out)


def running_xor(df: DataFrame, group: Sequence[str], order: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Add the exclusive or of long columns over their group's rows up to each row; ``columns`` gives input and name.

    Of hashes that depend on place and content, it identifies the sequence so far.
    """
    held = {f"_bits_{k}": F.coalesce(F.col(c), F.lit(0)).cast("long") for k, c in enumerate(columns)}
    dealt = deal_in_order(df.withColumns(held), group, order, running=tuple(held))
    tail = {c: F.max_by(c, "_at") for c in held}
    into = carried(dealt, tail, dict.fromkeys(held, 0), lambda a, b: {c: a[c] ^ b[c] for c in held})
    found = _given(dealt, into)
    for (c, _), out in zip(held.items(), columns.values()):
        before = F.when(F.col("_run") == 0, F.coalesce(f"_in_{c}", F.lit(0))).otherwise(0)
        found = found.withColumn(out, F.col(c).bitwiseXOR(before))
    return found.drop(*WORKING, "_out", *held, *[f"_in_{c}" for c in held])


def grouped_median(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact interpolating median of positive integers per group.

    The built-in exact percentile keeps all distinct values of a group in one
    buffer. Here values are counted first, then ranks are found on a log scale
    (a bounded number of buckets per group), and only the bucket or two holding
    the middle ranks are ordered.
    """
    counts = (
        df.where(F.col(value) > 0)
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.floor(F.log2(F.col(value).cast("double")) * 256))
    )
    g = W.partitionBy(*group)
    buckets = (
        counts.groupBy(*group, "_bucket")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_total", F.sum("_bn").over(g))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_bn").over(g.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .withColumn("_lo", F.expr("(_total - 1) div 2"))
        .withColumn("_hi", F.expr("_total div 2"))
        .where("_before <= _hi AND _before + _bn > _lo")
        .select(*group, "_bucket", "_before", "_lo", "_hi")
    )
    inside = W.partitionBy(*group, "_bucket").orderBy(value)
    ranked = (
        counts.join(buckets, [*group, "_bucket"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end")), F.col(value)))

    return ranked.groupBy(*group).agg(((at("_lo") + at("_hi")) / 2).alias(out))


def row_hash(df: DataFrame) -> Column:
    """A deterministic hash of all columns that have one, to deal rows by."""
    plain = [
        f"`{f.name}`"
        for f in df.schema.fields
        if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))
    ]
    return F.xxhash64(*plain) if plain else F.lit(0)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread: Column,
    salts: int = 16,
    how: str = "inner",
) -> DataFrame:
    """Join one-row-per-key ``small`` to ``big`` without piling up a hot key.

    Rows of a key are dealt over ``salts`` join keys by ``spread``; the small
    side is repeated once per salt. AQE may still turn it into a broadcast when
    the small side is measured to be small.

    The salts are a joined table of fixed size, as Catalyst's estimate of an
    exploded array leaves out its length: a table a little below the broadcast
    limit would be sent through the driver ``salts`` times over.
    """
    left = big.withColumn("_salt", F.pmod(spread.cast("bigint"), F.lit(salts)).cast("int"))
    right = small.crossJoin(F.broadcast(big.sparkSession.range(0, salts, 1, 1).select(F.col("id").cast("int").alias("_salt"))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
