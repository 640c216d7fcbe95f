"""Removing repeated byte strings: anchored windows in place of a suffix array.

The method asked for, a suffix order with longest-previous-factor arrays from
previous and next smaller positions, is **not** built here. A suffix order of
the whole corpus needs about as many rounds of sorting all positions as the
logarithm of the longest repeat, eight and more bytes for each position and
round, while the budget is four times the input. Instead the one question that
the rule asks, whether a position's factor reaches ``width``, is answered from
hashes of windows. Equality of contexts, chunk cores and windows rests on 64-bit
hashes; what lies beside a chunk's core is compared byte by byte.

What links the two: two positions share ``width`` bytes exactly when their suffixes, cut at
``width``, are equal, that is, when they lie in one run of the suffix order with
common prefixes of at least ``width``. Inside such a run a position's previous
and next smaller positions are earlier copies, so its longest previous factor
reaches ``width`` unless it is the run's least position, and its longest next
factor unless it is the greatest. Runs are therefore all that is needed: their
size and their least position.

The suffix order is built in two levels. Every window of ``width`` bytes has one
anchor, the least hashed ``width // 3``-gram inside it, which depends on its
bytes alone, so equal windows have equal anchors at equal offsets. Anchors that
occur once are settled there. Repeated anchors are grouped with the bytes of all
their windows (the context); equal contexts repeat as a whole, and only where one
anchor has several contexts are parts of them compared in the same way, first
chunks of neighbouring windows and then single windows, one for each group of
copies. All groups are counted by partial aggregation, so no
group of copies is gathered anywhere.

Defined cases: a missing text is empty; shorter texts than ``width`` keep all
bytes; equal rows repeat each other; rows with the same id and text are treated
alike and all stay; columns named like an added one are replaced; empty tables
give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import arrow_rows, stored, table, whole_text
from runlens.llm.registry import query

WIDTH = 200
# Window starts handled at once; also the room for a position in a packed minimum.
CHUNK = 1 << 19
# Window starts compared together at first, where single ones must be compared.
STEP = 16
SPREAD = np.uint64(0x9E3779B97F4A7C15)
ADDED = ("n_bytes", "n_removed", "n_spans", "kept_bytes")


class RollingHash:
    """64-bit hashes of any ranges of a byte string, from prefix sums."""

    BASE = 0xD6E8FEB86659FD93

    def __init__(self):
        self.values = np.random.default_rng(21).integers(1, 1 << 63, 256, np.uint64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def load(self, data: bytes) -> None:
        n = len(data)
        if len(self.powers) <= n:
            size = 2 * n + 1024
            for name, base in (("powers", self.BASE), ("inverses", pow(self.BASE, -1, 1 << 64))):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[np.frombuffer(data, np.uint8)] * self.powers[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        x = (self.sums[stop] - self.sums[start]) * self.inverses[start]
        x ^= x >> np.uint64(29)
        x *= SPREAD
        return x ^ (x >> np.uint64(32))

    def runs(self, width: int, first: int, last: int) -> np.ndarray:
        """Hashes of the ``width`` bytes at first .. last."""
        x = (self.sums[first + width : last + width + 1] - self.sums[first : last + 1]) * self.inverses[first : last + 1]
        x ^= x >> np.uint64(29)
        x *= SPREAD
        return x ^ (x >> np.uint64(32))


def anchors(hashes: RollingHash, size: int, width: int):
    """(anchor hash, context hash, first and last window start, anchor position) of the loaded text's anchors."""
    gram = width // 3
    room = width - gram + 1
    found = []
    low = np.uint64((1 << 20) - 1)
    for first in range(0, size - width + 1, CHUNK):
        last = min(first + CHUNK - 1, size - width)
        grams = hashes.runs(gram, first, last + room - 1)
        packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        least, reach = packed, 1
        while 2 * reach <= room:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < room:
            least = np.minimum(least[: len(grams) - room + 1], least[room - reach :][: len(grams) - room + 1])
        at = (least & low).astype(np.int64)  # leftmost least gram of each window
        begin = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        end = np.concatenate((begin[1:], [len(at)])) - 1
        lo, hi, anchor = begin + first, end + first, at[begin] + first
        context = hashes.ranges(lo, hi + width)
        shape = ((anchor - lo) * 4096 + (hi - lo)).astype(np.uint64)
        found.append((grams[at[begin]], context ^ (shape * SPREAD), lo, hi, anchor))
    return [np.concatenate(x) for x in zip(*found)]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


# Bits for a distance between window starts of one anchor, in a packed place.
NEAR = 12


def unpacked_places(rows: DataFrame) -> DataFrame:
    """``rows`` with lo, hi and at in place of ``place``."""
    bits = lambda shift: F.shiftright("place", shift).bitwiseAND((1 << NEAR) - 1)
    lo = F.shiftright("place", 2 * NEAR)
    others = [c for c in rows.columns if c != "place"]
    return rows.select(*others, lo.alias("lo"), (lo + bits(0)).alias("hi"), (lo + bits(NEAR)).alias("at"))


def anchor_rows(texts: DataFrame, width: int) -> DataFrame:
    """(_a, _b, h, c, place) of every anchor of every text; ``place`` packs first and last window start and anchor."""
    names = ["_a", "_b", "h", "c", "place"]
    if width >= 1 << NEAR:
        raise ValueError(f"windows of {width} bytes are too wide for packed places")

    def make():
        hashes = RollingHash()

        def step(batch):
            rows, size = [], 0

            def flush():
                joined = [np.concatenate(x) for x in zip(*rows)]
                return pa.RecordBatch.from_arrays([signed(x) for x in joined], names)

            for a, b, value in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)):
                data = value.as_py().encode()
                if len(data) < width:
                    continue
                hashes.load(data)
                h, c, lo, hi, at = anchors(hashes, len(data), width)
                place = lo << (2 * NEAR) | (at - lo) << NEAR | (hi - lo)
                rows.append((np.full(len(h), a), np.full(len(h), b), h, c, place))
                size += len(h)
                if size > 100_000:
                    yield flush()
                    rows, size = [], 0
            if rows:
                yield flush()

        return step

    return texts.mapInArrow(arrow_rows(make), "_a long, _b long, h long, c long, place long")


def chunk_rows(texts: DataFrame, width: int) -> DataFrame:
    """(h, k, left, right, n, _a, _b, lo, hi): the windows of the contexts in ``reps``, by chunks of neighbours.

    A chunk holds the windows that start at most ``STEP`` positions apart, by
    their distance from the anchor. They share a core, hashed to ``k``; what
    they have besides it is left and right of the core.
    """
    names = ["h", "k", "left", "right", "n", "_a", "_b", "lo", "hi"]

    def make():
        hashes = RollingHash()

        def step(batch):
            for a, b, value, reps in zip(*(batch.column(k) for k in range(4))):
                data = value.as_py().encode()
                hashes.load(data)
                h, lo, hi, at, n = (reps.values.field(k).to_numpy() for k in ("h", "lo", "hi", "at", "n"))
                first = (at - hi) // STEP
                counts = (at - lo) // STEP - first + 1
                which = np.repeat(np.arange(len(h)), counts)
                chunk = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[which]
                base = at[which] - STEP * chunk
                lo, hi = np.maximum(lo[which], base - STEP + 1), np.minimum(hi[which], base)
                end = base - STEP + 1 + width
                k = hashes.ranges(base, end) ^ (chunk.astype(np.uint64) * SPREAD)
                left = [data[x:y] for x, y in zip(lo.tolist(), base.tolist())]
                right = [data[x:y] for x, y in zip(end.tolist(), (hi + width).tolist())]
                same = [np.full(len(k), x.as_py()) for x in (a, b)]
                yield pa.RecordBatch.from_arrays(
                    [signed(h[which]), signed(k), pa.array(left, pa.binary()), pa.array(right, pa.binary())]
                    + [signed(x) for x in (n[which], *same, lo, hi)],
                    names,
                )

        return step

    kinds = "h long, k long, left binary, right binary, n long, _a long, _b long, lo long, hi long"
    return texts.mapInArrow(arrow_rows(make), kinds)


def settle(rows: DataFrame, key: list[str], context: list[str], keep_first: bool):
    """Groups of ``rows`` with equal key and context are copies.

    Returns the ranges of window starts that are copies (all, or all but the
    first of each group), and the groups, with their least row, whose key has
    other contexts too.
    """
    place = [c for c in ("_a", "_b", "lo", "hi", "at") if c in rows.columns]
    groups = stored(
        rows.groupBy(*key, *context).agg(F.sum("n").alias("n"), F.min(F.struct(*place)).alias("first")), "groups", "zstd"
    )
    copied = groups.filter("n > 1").select(*key, *context, "first")
    copies = rows.join(copied, [*key, *context])
    if keep_first:
        copies = copies.filter(F.struct(*place) != F.col("first"))
    several = groups.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select(*key)
    return copies.select("_a", "_b", "lo", "hi"), groups.join(several, key, "left_semi")


def repeated_starts(texts: DataFrame, width: int, keep_first: bool) -> DataFrame:
    """(_a, _b, lo, hi): ranges of window starts that are copies; all of them, or all but the first of each run."""
    rows = anchor_rows(texts, width)
    twice = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    met = unpacked_places(rows.join(twice, "h", "left_semi"))
    repeated = stored(met.withColumn("n", F.lit(1).cast("long")), "anchors", "zstd")
    by_context, contexts = settle(repeated, ["h"], ["c"], keep_first)
    reps = contexts.groupBy(F.col("first._a").alias("_a"), F.col("first._b").alias("_b")).agg(
        F.collect_list(F.struct("h", "first.lo", "first.hi", "first.at", "n")).alias("reps")
    )
    # Rows with one id and text are one entry here: their contexts were counted above.
    listed = texts.join(reps, ["_a", "_b"]).select("_a", "_b", "text", "reps").dropDuplicates(["_a", "_b"])
    chunks = stored(chunk_rows(listed, width), "chunks", "zstd")
    by_chunk, chunk_contexts = settle(chunks, ["h", "k"], ["left", "right"], keep_first)
    # A window takes the end of what is left of the core and the start of what is right of it.
    windows = (
        chunk_contexts.select("h", "k", "left", "right", "n", "first", F.explode(F.sequence("first.lo", "first.hi")).alias("p"))
        .withColumn("i", (F.col("first.lo") + F.length("left") - F.col("p")).cast("int"))
        .withColumn("w", F.xxhash64(F.expr("substring(left, length(left) - i + 1, i)"), F.expr(f"substring(right, 1, {STEP - 1} - i)")))
        .select("h", "k", "i", "w", "n", F.col("first._a").alias("_a"), F.col("first._b").alias("_b"), F.col("p").alias("lo"), F.col("p").alias("hi"))
    )
    by_window, _ = settle(stored(windows, "windows", "zstd"), ["h", "k", "i", "w"], [], keep_first)
    return by_context.union(by_chunk).union(by_window)


def cut(data: bytes, starts, width: int):
    """What is left of ``data`` and the number of runs removed, for ranges (lo, hi) of window starts."""
    if starts is None:
        return data, 0
    gone = np.zeros(len(data) + 1, np.int64)
    np.add.at(gone, starts[0], 1)
    np.add.at(gone, starts[1] + width, -1)
    gone = np.cumsum(gone)[:-1] > 0
    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), spans


def remove_repeats(docs: DataFrame, width: int = WIDTH, keep_first: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_bytes, n_removed, n_spans and kept_bytes; ``text`` becomes what is left.

    ``keep_first`` leaves the first copy of each string (in order of doc_id);
    else every copy goes. Characters cut in two are dropped from ``text``, not
    from ``kept_bytes``.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ADDED]).withColumn("text", whole_text())
    keyed = docs.withColumns(
        {"_a": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), "_b": F.xxhash64("doc_id", "text")}
    )
    ranges = (
        repeated_starts(keyed.select("_a", "_b", "text"), width, keep_first)
        .groupBy("_a", "_b")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("_ranges"))
    )
    joined = keyed.join(ranges, ["_a", "_b"], "left").select(*docs.columns, "_ranges")
    place, last = docs.columns.index("text"), len(docs.columns)
    schema = docs.withColumns(
        {k: F.lit(0).cast("long") for k in ADDED[:3]} | {"kept_bytes": F.lit(b"")}
    ).schema

    def make():
        def step(batch):
            texts, figures, kept = [], [], []
            for value, ranges_of in zip(batch.column(place), batch.column(last)):
                data = value.as_py().encode()
                starts = None
                if ranges_of.is_valid:
                    r = ranges_of.values
                    starts = r.field("lo").to_numpy(), r.field("hi").to_numpy()
                left, spans = cut(data, starts, width)
                figures.append((len(data), len(data) - len(left), spans))
                texts.append(left.decode("utf-8", "ignore"))
                kept.append(left)
            columns = [pa.array(texts, pa.string()) if k == place else batch.column(k) for k in range(last)]
            columns += [pa.array(x, pa.int64()) for x in zip(*figures)] + [pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

        return step

    return joined.mapInArrow(arrow_rows(make), schema)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without later copies of long strings; a document of nothing else goes."""
    left = remove_repeats(docs, keep_first=True)
    return left.filter("n_removed = 0 OR length(trim(text)) > 0").select(*docs.columns)


@query("op2_longest_factor")
def op2_longest_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, keep_first=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )
