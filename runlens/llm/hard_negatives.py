"""Hard negatives by cover-tree search: for each anchor and positive, the best other-label rows in a score window.

Candidates of one label and one corner of the space are put into blocks of at
most ``BLOCK_ROWS`` rows, each with its cover tree (``cover_tree``). The corners
are fit on a bounded sample of about ``SAMPLE_ROWS`` rows; every row is indexed,
and they decide how well a tree prunes, not what is found. Rows are dealt out by ranges
of (label, corner, hash), so a hot label or corner fills many blocks. Of rows
with one label and one vector only the ``POSITIVES + 1`` smallest ids can ever
be among the first, so only these are indexed.

Anchors are searched in blocks of about ``ANCHORS_AT_ONCE`` (a block of that
size travels to all tasks), against all rows: first in the trees of their own
label for positives, then in all other trees for the windows that their
positives' scores give. A task keeps five rows for each anchor and window over
all its trees; the lists of tasks are merged by a ranked window.

Defined cases: rows without label or vector, or with a missing or non-finite
component, take no part; rows equal in id, label and vector count once; rows
with an anchor's id are not its positives; a candidate without id comes last
among equal scores and is returned with a null id, an anchor needs an id; a
shorter vector is filled up with zeros; vectors so large that a score reaches
2^53 fail the run; anchors without positives, or windows without rows, give no
rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm.common import shared_folder, stored, table
from runlens.llm.cover_tree import NO_ID, Search, Tree
from runlens.llm.registry import query

POSITIVES = NEGATIVES = 5
# A negative scores at least this share (in percent) of its positive, and at most as much as it.
LEAST_PERCENT = 80
SCALE = 256
ANCHOR_EVERY = 100

BLOCK_ROWS = 4096
ANCHORS_AT_ONCE = 8192
SAMPLE_ROWS, MOST_CORNERS = 4096, 256


def scaled_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, q): distinct valid rows with whole-number components, as doubles of one width."""
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    valid = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad))
    rows = valid.select(
        vec_id.alias("vec_id"), moved.alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("q")
    )
    width = rows.agg(F.max(F.size("q"))).first()[0] or 0
    filled = F.concat("q", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("q")))
    return rows.withColumn("q", F.when(F.size("q") < width, filled).otherwise(F.col("q"))).distinct()


def matrix(column, width: int | None = None) -> np.ndarray:
    """A list column as rows of a matrix."""
    flat = column.flatten().to_numpy().astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, width or 0)


def corners_of(rows: DataFrame, n: int) -> np.ndarray:
    """Points far from one another, from a bounded sample; more of them for more rows."""
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    # About SAMPLE_ROWS rows by a hash of the whole row; equal rows were dropped before.
    picked = rows.filter(F.pmod(F.xxhash64(F.lit(29), "vec_id", "label", "q"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = np.array(sorted(r.q for r in picked.select("q").collect()), float)
    if not len(sample):
        return np.zeros((1, 0))
    chosen, away = [0], np.full(len(sample), np.inf)
    for _ in range(min(MOST_CORNERS, n // (8 * BLOCK_ROWS) + 1) - 1):
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(np.argmax(away)))
    return sample[chosen]


def build_index(rows: DataFrame) -> DataFrame:
    """Blocks of candidates with their trees: (label, ids, width, points, places, nodes), stored."""
    spark = rows.sparkSession
    copies = Window.partitionBy("label", "q").orderBy(F.col("vec_id").asc_nulls_last())
    kept = stored(rows.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= POSITIVES + 1).drop("_copy"), "candidates")
    n = kept.count()
    corners = corners_of(kept, n)

    def place(batches):
        half = (corners**2).sum(1) / 2
        for batch in batches:
            if not batch.num_rows:
                continue
            score = matrix(batch.column(2)) @ corners.T - half
            near = score.argmax(1)
            score[np.arange(len(score)), near] = -np.inf
            for name, values in (("_near", near), ("_next", score.argmax(1))):
                batch = batch.append_column(name, pa.array(values.astype(np.int32)))
            yield batch

    def build(batches):
        held: list = []

        def block():
            ids, points = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            places, nodes = Tree(points).packed()
            key = held[0][0]
            columns = [key[0], ids.tobytes(), points.shape[1], points.tobytes(), places, nodes]
            types = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, types)], ["label", "ids", "width", "points", "places", "nodes"])

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            label, near = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            points = matrix(batch.column(2))
            cut = np.flatnonzero((label[1:] != label[:-1]) | (near[1:] != near[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, len(ids)]):
                key = (int(label[a]), int(near[a]))
                if held and held[0][0] != key:
                    yield block()
                    held, size = [], 0
                while a < b:
                    end = min(b, a + BLOCK_ROWS - size)
                    held.append((key, ids[a:end], points[a:end]))
                    size, a = size + end - a, end
                    if size == BLOCK_ROWS:
                        yield block()
                        held, size = [], 0
        if held:
            yield block()

    parts = max(spark.sparkContext.defaultParallelism, n // (8 * BLOCK_ROWS) + 1)
    schema = kept.withColumns({"_near": F.lit(0), "_next": F.lit(0)}).schema
    by = ["label", "_near", "_next", F.xxhash64("vec_id", "q")]
    dealt = kept.mapInArrow(place, schema).repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return stored(dealt.mapInArrow(build, "label long, ids binary, width int, points binary, places binary, nodes binary"), "cover-trees")


def search(index: DataFrame, given, keep: int, same_label: bool) -> DataFrame:
    """(a, w, score, id, rank): the first ``keep`` rows of each anchor and window, from all trees.

    ``given`` is a broadcast (vectors, ids, labels, windows) of one block of anchors.
    """

    def look(batches):
        vectors, ids, labels, windows = given.value
        found = Search(vectors, ids, labels, windows, keep, same_label)
        for batch in batches:
            for row in range(batch.num_rows):
                label, own, width, points, places, nodes = (batch.column(k)[row].as_py() for k in range(6))
                own = np.frombuffer(own, np.int64)
                tree = Tree(np.frombuffer(points, float).reshape(len(own), width), (places, nodes))
                found.visit(tree, own, np.full(len(own), label))
        anchor, window, score, hit = found.rows()
        for k in range(0, len(anchor), 100_000):
            part = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[part].astype(np.int64)) for x in (anchor, window, score, hit)], ["a", "w", "score", "id"]
            )

    hits = index.mapInArrow(look, "a long, w long, score long, id long")
    best = Window.partitionBy("a", "w").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep)


def mine(embeddings: DataFrame) -> DataFrame:
    """One row for each anchor, positive and negative found."""
    spark = embeddings.sparkSession
    rows = stored(scaled_rows(embeddings), "vectors")
    index = build_index(rows)
    anchors = stored(rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0), "anchors")
    blocks = anchors.count() // ANCHORS_AT_ONCE + 1
    numbered = anchors.withColumn("_block", F.pmod(F.xxhash64("vec_id", "label", "q"), F.lit(blocks)))
    folder = shared_folder(spark, "negatives")
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for b in range(blocks):
        mined_block(numbered.filter(F.col("_block") == b), index, kinds).write.parquet(f"{folder}/block={b}")
    return spark.read.schema(kinds).parquet(*[f"{folder}/block={b}" for b in range(blocks)])


def mined_block(anchors: DataFrame, index: DataFrame, kinds: str) -> DataFrame:
    """The rows of one bounded block of anchors."""
    spark = anchors.sparkSession
    own = anchors.select("vec_id", "label", "q").orderBy("vec_id", "label", "q").toArrow().combine_chunks()
    n = own.num_rows
    if not n:
        return spark.createDataFrame([], kinds)
    vectors = np.array(own.column("q").to_pylist(), float).reshape(n, -1)
    ids, labels = own.column("vec_id").to_numpy(), own.column("label").to_numpy()
    everything = np.tile(np.array([-np.inf, np.inf]), (n, 1, 1))
    context = spark.sparkContext
    # At most POSITIVES rows for each anchor of the block.
    positives = search(index, context.broadcast((vectors, ids, labels, everything)), POSITIVES, True).collect()
    windows = np.full((n, POSITIVES, 2), np.nan)
    positive = np.full((n, POSITIVES), NO_ID, np.int64)
    for r in positives:
        # Whole scores from 80 % on, rounded up; a negative score has no window.
        windows[r.a, r.rank - 1] = (-(-LEAST_PERCENT * r.score // 100), r.score)
        positive[r.a, r.rank - 1] = r.id
    hits = search(index, context.broadcast((vectors, ids, labels, windows)), NEGATIVES, False)
    names = context.broadcast((ids, positive, windows[..., 1]))

    def named(batches):
        own, other, top = names.value
        for batch in batches:
            a, w, score, hit, rank = (batch.column(k).to_numpy() for k in range(5))
            nothing = lambda x: pa.array(x, mask=x == NO_ID)
            columns = [pa.array(own[a]), nothing(other[a, w]), pa.array(rank.astype(np.int32)), nothing(hit)]
            columns += [pa.array(top[a, w].astype(np.int64)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in kinds.split(", ")])

    return hits.mapInArrow(named, kinds)


NEGATIVES_SQL = """WITH valid AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM valid a, valid c WHERE a.vec_id % 100 = 0 AND (a.label <> c.label OR a.vec_id <> c.vec_id)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))
