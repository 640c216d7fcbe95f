"""Tables that grow by commits: written once, read whole, however often a job is tried.

A commit stages its files in a folder of its own and adds one manifest row at
the end. Readers take the newest manifest of each commit name, so files of a
failed try are never seen, a second try of the same name takes the place of the
first, and two names are both there. Nothing is moved or rewritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.session import partitions_by_size

MANIFEST = "folder STRING, rows BIGINT"
# Steps of one series that lie in one file.
STEPS_PER_FILE = 1_000_000


def _manifests(spark: SparkSession, root: str) -> DataFrame:
    full = T.StructType.fromDDL(MANIFEST).add("commit", T.StringType()).add("seq", T.LongType())
    base = f"{root}/_commits"
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], full)
    # Underscored folders are hidden from readers unless they are named.
    return spark.read.schema(full).option("basePath", base).json(f"{base}/*/*")


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The manifest that counts of each commit: ``(commit, seq, folder, rows)``."""
    newest = F.max_by(F.struct("seq", "folder", "rows"), "seq").alias("c")
    return _manifests(spark, root).groupBy("commit").agg(newest).select("commit", "c.*")


def commit(
    rows: DataFrame,
    root: str,
    name: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Write ``rows`` as the commit ``name`` of the table ``root``.

    ``cluster_by`` deals rows over files, ``sort_by`` orders them inside; a
    file-level minimum and maximum of the leading columns then let readers skip.
    """
    spark = rows.sparkSession
    if not name or any(c in name for c in "/=*"):
        raise ValueError(f"{name!r} cannot name a commit")
    seq = _manifests(spark, root).where(F.col("commit") == name).agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0] + 1
    folder = f"files/{name}-{seq}-{uuid.uuid4().hex[:12]}"
    dealt = rows.repartition(*partitions_by_size(rows), *partition_by, *cluster_by) if cluster_by else rows
    if sort_by:
        dealt = dealt.sortWithinPartitions(*partition_by, *sort_by)
    dealt.write.partitionBy(*partition_by).parquet(f"{root}/{folder}")
    written = spark.read.schema(rows.schema).parquet(f"{root}/{folder}").count()
    row = spark.createDataFrame([(folder, written)], MANIFEST)
    # The last step: only a whole manifest folder makes the files part of the table.
    row.coalesce(1).write.mode("error").json(f"{root}/_commits/commit={name}/seq={seq}")


def committed(spark: SparkSession, root: str, schema: T.StructType | str, names: Sequence[str] | None = None) -> DataFrame:
    """All committed rows with their ``commit``, or those of some commits.

    The driver holds one path for each commit.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = commits(spark, root)
    if names is not None:
        found = found.where(F.col("commit").isin(*names)) if names else found.where(F.lit(False))
    parts = [
        spark.read.schema(struct).parquet(f"{root}/{r['folder']}").withColumn("commit", F.lit(r["commit"]))
        for r in found.orderBy("commit").collect()
    ]
    if not parts:
        return spark.createDataFrame([], T.StructType([*struct.fields, T.StructField("commit", T.StringType())]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_samples(samples: DataFrame, root: str, name: str) -> None:
    """A commit of samples by slot, clustered by series and block of steps, in order of steps.

    A long series becomes many files, and a scan of one series or range of steps
    skips files and row groups by their minima and maxima.
    """
    block = F.expr(f"step DIV {STEPS_PER_FILE}")
    commit(samples, root, name, ["slot"], ["episode_id", "key", block], ["episode_id", "key", "step"])


def write_episodes(episodes: DataFrame, root: str, name: str) -> None:
    """A commit of catalogue rows, ordered by episode."""
    commit(episodes, root, name, cluster_by=["episode_id"], sort_by=["episode_id"])


def read_episodes(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """The catalogue: one row for each episode, of the last commit by name that logged it."""
    rows = committed(spark, root, schema)
    rest = [c for c in rows.columns if c not in ("episode_id", "commit")]
    newest = rows.groupBy("episode_id").agg(F.max_by(F.struct(*rest, "commit"), "commit").alias("e"))
    return newest.select("episode_id", "e.*")
