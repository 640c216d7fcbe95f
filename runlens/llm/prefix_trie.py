"""The prefix trie of conversations, with subtree totals by parallel tree contraction.

Turns are numbered in their conversations by ranges of (conversation, turn).
A turn is known by the 128-bit hash of role and text, a prefix by two 64-bit
exclusive ors over hashes of (place, turn); equality of prefixes rests on these.
Grouping the prefixes of all conversations gives the nodes, each named by its
smallest member and its depth, which is unique. Subtree totals come from
``contraction``. No conversation, node or set of children is gathered in a task;
the ids that end at one node are hashed in ascending order as a stream, as the
digest requires, from a sort that spills.

Rebuilding (``rebuild``): conversation c begins with the first h turns of
conversation c - c % 100 and goes on with its own turns after its first h;
h = crc32(decimal c) % 6.

Defined cases: rows without conv_id are no conversation; a missing role or text
is empty; turns of one number (missing ones first) are ordered by the hash of
role and text, and repeated rows are turns of their own; conversations without a
turn after rebuilding end at the root; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import stored, table
from runlens.llm.contraction import subtree_totals
from runlens.llm.registry import query
from runlens.operators.ordering import number_rows, running_xor

STEM = 100
MOST_SHARED = 6
# Own turns that meet their conversation's figures under one join key.
TURNS_AT_ONCE = 1 << 16
KEY = ("depth", "x1", "x2")
NOTHING = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, said, chars): turns numbered from 0; ``said`` identifies role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("said"), F.length(text).cast("long").alias("chars")
    )
    return number_rows(turns, ["conv_id"], ["turn", "said"], out="at").drop("turn")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, total) of all conversations, and (conv_id, total, depth, said, chars) of their rebuilt turns."""
    convs = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversations")
    convs = convs.select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % STEM).alias("stem"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).alias("h"),
    )
    stems = convs.filter(F.col("conv_id") == F.col("stem")).select(F.col("conv_id").alias("stem"), F.col("n").alias("_stem_n"))
    shared = F.least("h", F.coalesce("_stem_n", F.lit(0)))
    convs = convs.join(stems, "stem", "left").withColumn("shared", shared)
    convs = convs.withColumn("total", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "stem", "n", "h", "shared", "total"), "conversations")
    # A stem gives at most five turns to at most a hundred conversations.
    heads = turns.filter((F.col("at") < MOST_SHARED - 1) & (F.col("conv_id") % STEM == 0)).withColumnRenamed("conv_id", "stem")
    first = convs.join(heads, "stem").filter("at < h").select("conv_id", "total", (F.col("at") + 1).alias("depth"), "said", "chars")
    spans = convs.filter("n > h").withColumn("_span", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) DIV {TURNS_AT_ONCE}"))))
    own = turns.withColumn("_span", F.expr(f"at DIV {TURNS_AT_ONCE}")).join(spans.drop("stem"), ["conv_id", "_span"]).filter("at >= h")
    own = own.select("conv_id", "total", (F.col("at") - F.col("h") + F.col("shared") + 1).alias("depth"), "said", "chars")
    return convs.select("conv_id", "total"), first.union(own)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256): the ids that end at each node, ascending and joined by commas, as a digest."""

    def digest(batches):
        last, running = None, None
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in range(3)]
            ids = batch.column(3).to_pylist()
            new = np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))) if ids else np.zeros(0, bool)
            begins = np.flatnonzero(new)
            out = []
            for a, b in zip(begins, [*begins[1:], len(ids)]):
                key = tuple(int(k[a]) for k in keys)
                text = ",".join(map(str, ids[a:b])).encode()
                if key == last:
                    running.update(b"," + text)
                else:
                    if last is not None:
                        out.append((*last, running.hexdigest()))
                    last, running = key, hashlib.sha256(text)
            if out:
                yield as_batch(out)
        if last is not None:
            yield as_batch([(*last, running.hexdigest())])

    def as_batch(rows):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*KEY, "ends_sha256"])

    ordered = ends.select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return ordered.mapInArrow(digest, "depth long, x1 long, x2 long, ends_sha256 string")


def nodes_of(convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """One row for each node: its key and its parent's (p1, p2), conv_id, n_convs, chars, n_children, parent_conv_id, ends_sha256."""
    hashes = {f"h{k}": F.xxhash64(F.lit(k), "depth", "said") for k in (1, 2)}
    prefixes = stored(running_xor(rebuilt.withColumns(hashes).drop("said"), ["conv_id"], ["depth"], {"h1": "x1", "h2": "x2"}), "prefixes")
    parent = {f"p{k}": F.col(f"x{k}").bitwiseXOR(F.col(f"h{k}")) for k in (1, 2)}
    inner = prefixes.withColumns(parent).groupBy(*KEY).agg(
        *[F.first(p).alias(p) for p in parent], F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("chars").alias("chars")
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), none.alias("p1"), none.alias("p2"), "conv_id", "n_convs", zero.alias("chars")
    )
    nodes = stored(inner.unionByName(root), "nodes")
    ends = prefixes.filter("depth = total").select(*KEY, "conv_id")
    ends = ends.union(convs.filter("total = 0").select(*[zero.alias(k) for k in KEY], "conv_id"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children"))
    named = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return stored(
        nodes.join(children, list(KEY), "left")
        .join(end_hashes(ends), list(KEY), "left")
        .fillna(0, ["n_children"])
        .fillna(NOTHING, ["ends_sha256"])
        # A node with very many children is a hot key on the left alone; Spark splits such partitions.
        .join(named, ["depth", "p1", "p2"], "left"),
        "named-nodes",
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations, with its subtree's totals."""
    nodes = nodes_of(*rebuild(turns_of(conversations)))
    name = F.struct(F.col("conv_id"), F.col("depth"))
    parent = F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")))
    totals = subtree_totals(
        nodes.select(
            name.alias("id"), parent.alias("parent"), F.col("depth").alias("level"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    return nodes.join(totals.select("id.conv_id", "id.depth", "n_leaves", "saved_tokens"), ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


# The checksum, bit by bit over the digits of the id: a number from 0 on is a byte to take in, -1 a step of one bit.
CRC32 = """list_reduce(flatten([[4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))]),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"""

TRIE_SQL = f"""WITH raw AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS i FROM raw),
convs AS (
  SELECT conv_id, n, conv_id - conv_id % 100 AS stem, xor({CRC32}, 4294967295) % 6 AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)),
known AS (
  SELECT c.*, least(c.h, coalesce(s.n, 0)) AS shared
  FROM convs c LEFT JOIN convs s ON s.conv_id = c.stem),
rebuilt AS (
  SELECT k.conv_id, t.i AS depth, said, chars FROM known k JOIN turns t ON t.conv_id = k.stem AND t.i <= k.h
  UNION ALL
  SELECT k.conv_id, t.i - k.h + k.shared, said, chars FROM known k JOIN turns t ON t.conv_id = k.conv_id AND t.i > k.h),
prefixes AS (
  SELECT conv_id, depth, chars, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
members AS (
  SELECT conv_id AS member, depth, chars, count(*) OVER w AS n_convs, min(conv_id) OVER w AS conv_id,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM prefixes WINDOW w AS (PARTITION BY depth, prefix)),
nodes AS (
  SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, m.chars
  FROM members m LEFT JOIN members p ON p.member = m.member AND p.depth = m.depth - 1
  WHERE m.member = m.conv_id),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (conv_id, depth)),
totals AS (
  SELECT a.conv_id, a.depth, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.chars) AS saved
  FROM counted b JOIN members a ON a.member = b.conv_id AND a.depth <= b.depth
  GROUP BY ALL),
ended AS (
  SELECT conv_id, depth, string_agg(member::VARCHAR, ',' ORDER BY member) AS ids FROM members WHERE ends GROUP BY ALL)
SELECT c.conv_id, c.depth::BIGINT AS depth, c.parent_conv_id, c.n_convs, c.n_children, t.n_leaves, t.saved::BIGINT AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted c JOIN totals t USING (conv_id, depth) LEFT JOIN ended e USING (conv_id, depth)"""


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
