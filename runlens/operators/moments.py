"""Mergeable moments of vectors: count, mean and sum of squared deviations of each component.

A batch of rows is reduced to one row of arrays for each of its groups before
anything is shuffled; partial rows of a group merge in any number and order by
the same step. So a vector never becomes a row for each component, and a group
with very many rows sends on a few rows for each batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows in which a component stands, those where it is a number or NaN, their mean, their squared deviations.
PARTS = ("n", "m", "mean", "m2")
KINDS = (pa.int64(), pa.int64(), pa.float64(), pa.float64())


def merged(group: np.ndarray, place: np.ndarray, parts: Sequence[np.ndarray]) -> tuple:
    """Sorted distinct (group, place) pairs and their merged parts."""
    by = np.lexsort((place, group))
    group, place = group[by], place[by]
    n, m, mean, m2 = (x[by] for x in parts)
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (place[1:] != place[:-1])))
    slot = np.cumsum(new) - 1
    size = int(slot[-1]) + 1
    total = lambda x: np.bincount(slot, x, size)
    counted = total(m)
    with np.errstate(invalid="ignore", divide="ignore"):
        middle = total(np.where(m > 0, m * mean, 0.0)) / counted
        away = np.where(m > 0, m2 + m * (mean - middle[slot]) ** 2, 0.0)
    return group[new], place[new], (total(n).astype(np.int64), counted.astype(np.int64), middle, total(away))


def _groups(columns: Sequence[pa.Array]) -> np.ndarray:
    """Numbers of equal rows of the key columns, in order of their first."""
    import pandas as pd

    frame = pd.DataFrame({str(k): c.to_pandas() for k, c in enumerate(columns)})
    return frame.groupby(list(frame.columns), sort=False, dropna=False).ngroup().to_numpy()


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _reduced(keys: list, group: np.ndarray, place: np.ndarray, parts, names: list[str]):
    """One row for each group, from its components."""
    g, p, merged_parts = merged(group, place, parts)
    number, sizes = np.unique(g, return_counts=True)
    columns = [k.take(pa.array(number)) for k in keys]
    columns += [_lists(x, sizes, kind) for x, kind in zip(merged_parts, KINDS)]
    return pa.RecordBatch.from_arrays(columns, names)


def vector_moments(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys`` with the arrays ``n``, ``m``, ``mean`` and ``m2`` over the vectors of each group.

    Missing vectors count nowhere; a missing component counts in ``n`` alone.
    Groups without any component give no row.
    """
    names = [*keys, *PARTS]
    schema = T.StructType([rows.schema[k] for k in keys])
    for name, kind in zip(PARTS, (T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType())):
        schema = schema.add(name, T.ArrayType(kind))

    def heads(batch: pa.RecordBatch, group: np.ndarray) -> list:
        first = np.unique(group, return_index=True)[1]
        return [batch.column(k).take(pa.array(first)) for k in range(len(keys))]

    def start(batches):
        for batch in batches:
            vectors = batch.column(len(keys))
            sizes = vectors.value_lengths().fill_null(0).to_numpy()
            if not sizes.sum():
                continue
            group = _groups([batch.column(k) for k in range(len(keys))])
            flat = vectors.flatten()
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            x = np.where(known, flat.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0)
            place = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            parts = (np.ones(len(x)), known.astype(float), x, np.zeros(len(x)))
            yield _reduced(heads(batch, group), np.repeat(group, sizes), place, parts, names)

    def merge(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                # Columns are joined, not batches: Spark's know of fields that cannot be null, and name list items in its way.
                both = [pa.concat_arrays([a.cast(b.type), b]) for a, b in zip(held.columns, batch.columns, strict=True)]
                batch = pa.RecordBatch.from_arrays(both, names)
            group = _groups([batch.column(k) for k in range(len(keys))])
            lists = [batch.column(len(keys) + k) for k in range(4)]
            sizes = lists[0].value_lengths().to_numpy()
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            parts = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
            out = _reduced(heads(batch, group), np.repeat(group, sizes), place, parts, names)
            # Rows come sorted by key, so only the last group can go on.
            if out.num_rows > 1:
                yield out.slice(0, out.num_rows - 1)
            held = out.slice(out.num_rows - 1)
        if held is not None:
            yield held

    partial = rows.select(*keys, F.col(value).cast("array<double>").alias("value")).mapInArrow(start, schema)
    dealt = partial.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(merge, schema)
