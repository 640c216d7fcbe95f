"""Queries on per-frame datasets, demonstrations and files."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators import outcomes, pack, quality, sink
from runlens.operators.ordering import number_rows
from runlens.plans import bindings as B
from runlens.plans import staging
from runlens.plans.registry import query
from runlens.session import materialize
from runlens.sources import arrays, demos, frames


def _count() -> Column:
    return F.count(F.lit(1)).alias("n")


# ── frame scans ──────────────────────────────────────────────────────

_FRAMES_SQL = """SELECT l_suppkey AS episode_index, count(*) AS n, count(*) - 1 AS last_frame,
       round(sum(l_quantity::FLOAT::DOUBLE), 3) AS total FROM lineitem"""


def _frame_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("episode_index").agg(
        _count(),
        F.max("frame_index").alias("last_frame"),
        F.round(F.sum(F.col("`observation.state`")[0].cast("double")), 3).alias("total"),
    )


@query("scan_frames_v2", f"{_FRAMES_SQL} GROUP BY 1")
def scan_frames_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staging.fresh(spark, "frames-v2")
    staging.frames_by_file(staging.line_frames(spark, sf_dir), root)
    return _frame_totals(frames.scan_frames_v2(spark, root))


@query(
    "slice_episode",
    """SELECT s_suppkey AS episode_index, count(l_suppkey) AS n,
       round(coalesce(sum(l_quantity::FLOAT::DOUBLE), 0), 3) AS total, count(l_suppkey) = 0 AS empty
       FROM (SELECT s_suppkey FROM supplier WHERE s_acctbal < 5000 UNION ALL SELECT -1) s
       LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1""",
)
def slice_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staging.fresh(spark, "frames-v3")
    # Shards hold ranges of episodes in order, as datasets of this version do.
    ordered = staging.line_frames(spark, sf_dir).repartitionByRange("episode_index").sortWithinPartitions("episode_index", "frame_index")
    # Every seek fills a read buffer of up to 64 KB, so row groups are many times as large.
    ordered.write.option("parquet.block.size", 1 << 22).parquet(f"{root}/data/chunk-000")
    shards = frames.scan_frames_v3(spark, root)
    wanted = (
        B.table(spark, sf_dir, "supplier")
        .where("s_acctbal < 5000")
        .select(F.col("s_suppkey").alias("episode_index"))
        .unionByName(spark.sql("SELECT -1L AS episode_index"))
    )
    found = frames.slice_episodes(shards, wanted).groupBy("episode_index").agg(
        _count(),
        F.round(F.sum(F.col("`observation.state`")[0].cast("double")), 3).alias("total"),
        F.lit(False).alias("empty"),
    )
    nothing = frames.empty_episodes(wanted, shards).select(
        "episode_index", F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("total"), F.lit(True).alias("empty")
    )
    return found.unionByName(nothing)


_INFO_CASE = "CASE WHEN s_suppkey % 10 = 7 THEN 'list' WHEN s_suppkey % 10 = 8 THEN 'bad' ELSE 'object' END"


@query(
    "scan_info",
    f"""SELECT kind AS problem, version, support, count(*) AS n, sum(CASE WHEN version IS NOT NULL THEN s_suppkey END)::BIGINT AS frames FROM (
      SELECT s_suppkey, CASE {_INFO_CASE} WHEN 'list' THEN 'not a JSON object but ARRAY<BIGINT>' WHEN 'bad' THEN 'not valid JSON' END AS kind,
             CASE WHEN {_INFO_CASE} = 'object' THEN CASE s_suppkey % 3 WHEN 0 THEN 'v2.1' WHEN 1 THEN 'v3.0' ELSE 'v4.0' END END AS version,
             CASE WHEN {_INFO_CASE} <> 'object' THEN 'unknown' WHEN s_suppkey % 3 = 2 THEN 'newer' ELSE 'ok' END AS support
      FROM supplier) GROUP BY ALL""",
)
def scan_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    version = F.when(k % 3 == 0, "v2.1").when(k % 3 == 1, "v3.0").otherwise("v4.0")
    body = F.to_json(
        F.struct(
            version.alias("codebase_version"),
            F.lit(10).alias("fps"),
            k.alias("total_frames"),
            F.struct(F.struct(F.lit("float32").alias("dtype")).alias("action")).alias("features"),
        )
    )
    line = F.when(k % 10 == 7, "[1,2]").when(k % 10 == 8, "{broken").otherwise(body)
    root = staging.fresh(spark, "info")
    # Each row becomes a file, so the work is in the files: they are dealt over all cores, and read once.
    texts = B.table(spark, sf_dir, "supplier").select(line.alias("line")).repartition(spark.sparkContext.defaultParallelism * 4, "line")
    texts.write.option("maxRecordsPerFile", 1).text(root)
    info = materialize(frames.scan_info(spark, root), "info-read")
    facts = frames.info_features(info).select("path", "codebase_version", "support", "total_frames")
    return (
        info.join(facts, "path")
        .groupBy("problem", F.col("codebase_version").alias("version"), "support")
        .agg(_count(), F.sum("total_frames").alias("frames"))
    )


_JSONL_SQL = """WITH o AS (
      SELECT *, o_custkey // 50 AS g, row_number() OVER (PARTITION BY o_custkey // 50 ORDER BY o_orderkey) - 1 AS pos FROM orders)
    SELECT g, pos, CASE WHEN o_orderkey % 5 = 0 THEN pos ELSE o_orderkey END AS episode_index,
           CASE o_orderkey % 3 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey + 1 ELSE 0 END AS length FROM o"""


@query("scan_episodes_jsonl", _JSONL_SQL)
def scan_episodes_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    index = F.when(k % 5 != 0, k)
    length = F.when(k % 3 == 0, F.col("o_custkey")).when(k % 3 == 1, 0)
    body = F.to_json(
        F.struct(
            index.alias("episode_index"),
            length.alias("length"),
            F.when(k % 3 == 1, F.col("o_custkey") + 1).alias("episode_length"),
        )
    )
    rows = B.table(spark, sf_dir, "orders").select(
        F.expr("o_custkey div 50").alias("g"),
        k.alias("at"),
        # Blank lines do not count as positions.
        F.explode(F.when(k % 7 == 0, F.array(F.lit("  "), body)).otherwise(F.array(body))).alias("line"),
    )
    root = staging.fresh(spark, "episodes-jsonl")
    staging.text_files(rows, root, "g", "at")
    got = frames.scan_episodes_jsonl(spark, f"{root}/*")
    return got.select(
        F.regexp_extract("path", r"/g=(\d+)\.", 1).cast("bigint").alias("g"), "pos", "episode_index", "length"
    )


_CAMS = ("observation.images.top", "observation.images.wrist")


def _episode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    start = k / 2
    cols = [k.alias("episode_index"), F.col("o_custkey").alias("length")]
    for i, cam in enumerate(_CAMS):
        cols += [
            F.expr("o_orderkey div 1000").alias(f"videos/{cam}/chunk_index"),
            F.when(k % (i + 3) != 0, k % 1000).alias(f"videos/{cam}/file_index"),
            start.alias(f"videos/{cam}/from_timestamp"),
            F.when(k % 11 != i, start + 1).alias(f"videos/{cam}/to_timestamp"),
        ]
    return B.table(spark, sf_dir, "orders").select(*cols)


@query(
    "scan_episodes_v3",
    "SELECT o_orderkey AS episode_index, o_custkey AS length FROM orders",
)
def scan_episodes_v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staging.fresh(spark, "episodes-v3")
    _episode_rows(spark, sf_dir).write.parquet(f"{root}/meta/episodes/chunk-000")
    return frames.scan_episodes_v3(spark, root).select("episode_index", "length")


@query(
    "video_locators",
    """SELECT o_orderkey AS episode_index, c AS camera, o_orderkey // 1000 AS chunk_index, o_orderkey % 1000 AS file_index,
              o_orderkey / 2.0::DOUBLE AS from_timestamp, o_orderkey / 2.0::DOUBLE + 1 AS to_timestamp
       FROM orders, (VALUES (0, 'observation.images.top'), (1, 'observation.images.wrist')) v(i, c)
       WHERE o_orderkey % (i + 3) <> 0 AND o_orderkey % 11 <> i""",
)
def video_locators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.video_locators(_episode_rows(spark, sf_dir), _CAMS)


@query(
    "scan_tasks",
    """SELECT c_custkey AS task_index, CASE c_custkey % 4 WHEN 3 THEN '' ELSE c_mktsegment END
              || CASE WHEN c_custkey % 5 = 0 AND c_custkey % 4 <> 3 THEN '!' ELSE '' END AS task FROM customer""",
)
def scan_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_mktsegment")

    def line(text: Column) -> Column:
        task = F.when(k % 4 == 0, text).when(k % 4 == 2, "")
        description = F.when(k % 4 != 3, text)
        return F.to_json(F.struct(k.alias("task_index"), task.alias("task"), description.alias("description")))

    noise = F.array(F.lit('{"task_index":"x","task":"bad"}'), F.lit('{"task":"no index"}'))
    lines = F.concat(
        F.array(line(name)), noise, F.when(k % 5 == 0, F.array(line(F.concat(name, F.lit("!"))))).otherwise(F.array())
    )
    rows = B.table(spark, sf_dir, "customer").select(
        F.expr("c_custkey div 50").alias("g"), k, F.posexplode(lines).alias("p", "line")
    )
    root = staging.fresh(spark, "tasks")
    staging.text_files(rows.select("g", (k * 10 + F.col("p")).alias("at"), "line"), root, "g", "at")
    return frames.tasks_from_lines(spark, f"{root}/*")


@query(
    "task_lookup",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || ',' || c_mktsegment WHEN 1 THEN c_mktsegment
              ELSE coalesce(n_name, '') END AS tasks
       FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 4""",
)
def task_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    eps = B.table(spark, sf_dir, "customer").select(
        k,
        F.when(k % 3 == 0, F.array("c_name", "c_mktsegment")).alias("tasks"),
        F.when(k % 3 == 1, F.col("c_mktsegment")).otherwise("").alias("task"),
        F.when(k % 3 == 2, F.col("c_nationkey")).alias("task_index"),
    )
    tasks = B.table(spark, sf_dir, "nation").where("n_regionkey < 4").select(
        F.col("n_nationkey").alias("task_index"), F.col("n_name").alias("task")
    )
    return frames.with_tasks(eps, tasks).select("c_custkey", F.array_join("task_list", ",").alias("tasks"))


@query(
    "dataset_summary",
    """WITH e AS (SELECT conv_id, conv_id // 10 AS path, count(*) AS length FROM conversations GROUP BY ALL)
    SELECT path, CASE path % 3 WHEN 0 THEN 7 ELSE count(*) END AS total_episodes,
           CASE path % 3 WHEN 0 THEN 70 ELSE sum(length)::BIGINT END AS total_frames FROM e GROUP BY path""",
)
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    eps = B.table(spark, sf_dir, "conversations").groupBy(
        "conv_id", F.expr("conv_id div 10").alias("path")
    ).agg(F.count(F.lit(1)).alias("length"))
    p = F.col("path")
    info = eps.select("path").distinct().select(
        "path",
        F.when(p % 3 == 0, 7).when(p % 3 == 1, 0).cast("bigint").alias("total_episodes"),
        F.when(p % 3 == 0, 70).when(p % 3 == 1, 0).cast("bigint").alias("total_frames"),
    )
    return frames.dataset_summary(info, eps)


_FEATURES_SQL = """features AS (
  SELECT DISTINCT user_id AS path,
         CASE WHEN event_type IN ('signup', 'view') THEN 'observation.images.' || event_type ELSE 'observation.' || event_type END AS name,
         CASE WHEN user_id % 2 = 0 AND event_type IN ('signup', 'error') THEN 'video' ELSE 'float32' END AS dtype FROM events)"""


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return B.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("path"),
        F.concat(
            F.when(kind.isin("signup", "view"), "observation.images.").otherwise("observation."), kind
        ).alias("name"),
        F.when((F.col("user_id") % 2 == 0) & kind.isin("signup", "error"), "video").otherwise("float32").alias("dtype"),
    ).distinct()


@query(
    "camera_keys",
    f"""WITH {_FEATURES_SQL}, d AS (SELECT path, bool_or(dtype = 'video') AS declared FROM features GROUP BY 1)
    SELECT path, name FROM features JOIN d USING (path)
    WHERE CASE WHEN declared THEN dtype = 'video' ELSE name LIKE 'observation.images.%' END""",
)
def camera_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.camera_keys(_features(spark, sf_dir)).select("path", "name")


@query(
    "report_features",
    """WITH f AS (SELECT DISTINCT l_suppkey AS path, 'feature_' || lpad((l_quantity::INT)::VARCHAR, 2, '0') AS name FROM lineitem),
    r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY name) AS rn, count(*) OVER (PARTITION BY path) AS c FROM f)
    SELECT path, string_agg(name, ', ' ORDER BY name) || CASE WHEN max(c) > 8 THEN ' (+' || (max(c) - 8) || ' more)' ELSE '' END AS features
    FROM r WHERE rn <= 8 GROUP BY path""",
)
def report_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")
    lines = B.table(spark, sf_dir, "lineitem")
    named = lines.select(F.col("l_suppkey").alias("path"), F.concat(F.lit("feature_"), quantity).alias("name"))
    hidden = lines.select(
        F.col("l_suppkey").alias("path"),
        F.explode(F.array(F.lit("timestamp"), F.lit("index"), F.lit("observation.images.top"))).alias("name"),
    )
    return frames.feature_text(named.unionByName(hidden).distinct(), limit=8)


# ── packing frames ───────────────────────────────────────────────────

_DECLARED = [
    "observation.state",
    "observation.ragged",
    "observation.line",
    "observation.flag",
    "observation.absent",
    "action",
]


@query(
    "pack_series",
    f"""WITH {B.line_sql()},
    sizes AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1),
    series AS (
      SELECT s.episode_id, s.step, u.key, u.slot, u.x FROM steps s JOIN sizes USING (l_suppkey),
      LATERAL (VALUES ('observation.state/value', 'sensors', l_quantity::FLOAT::DOUBLE + l_discount::FLOAT::DOUBLE),
                      ('observation.ragged/value', 'sensors', CASE WHEN l_suppkey % 2 = 1 OR n < 50 THEN l_quantity::FLOAT::DOUBLE + l_discount::FLOAT::DOUBLE END),
                      ('observation.line/value', 'sensors', l_linenumber),
                      ('action/value', 'actions', l_tax::FLOAT::DOUBLE * 3)) u(key, slot, x)
      WHERE u.x IS NOT NULL)
    SELECT episode_id, key, slot, count(*) AS n, max(trunc(((step / 10.0::DOUBLE)::FLOAT)::DOUBLE * 1e9::DOUBLE)::BIGINT) AS last_t_ns,
           round(sum(x), 3) AS total FROM series GROUP BY ALL""",
)
def pack_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples, _ = pack.pack_frames(staging.line_frames(spark, sf_dir), _DECLARED)
    total = F.aggregate(F.col("value").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return samples.groupBy("episode_id", "key", "slot").agg(
        _count(), F.max("t_ns").alias("last_t_ns"), F.round(F.sum(total), 3).alias("total")
    )


def _fails_midway(rows: DataFrame, when: Column) -> DataFrame:
    """``rows``, but a row where ``when`` holds ends the job."""
    broken = F.when(when, F.raise_error(F.lit("broken on purpose")).cast("bigint")).otherwise(F.col("step"))
    return rows.withColumn("step", broken)


@query(
    "write_samples",
    f"""WITH {B.line_sql()},
    series AS (
      SELECT s.episode_id, s.step, u.key, u.slot, u.x, u.w FROM steps s,
      LATERAL (VALUES ('observation.state/value', 'sensors', l_quantity::FLOAT::DOUBLE + l_discount::FLOAT::DOUBLE, 2),
                      ('observation.line/value', 'sensors', l_linenumber, 1),
                      ('action/value', 'actions', l_tax::FLOAT::DOUBLE * 3, 3)) u(key, slot, x, w))
    SELECT CASE WHEN episode_id % 2 = 0 THEN 'even' ELSE 'odd' END AS "commit", episode_id, key, slot, count(*) AS n,
           max(step) AS last_step, max(trunc(((step / 10.0::DOUBLE)::FLOAT)::DOUBLE * 1e9::DOUBLE)::BIGINT) AS last_t_ns,
           round(sum(x), 3) AS total, sum(w)::BIGINT AS numbers
    FROM series GROUP BY ALL""",
)
def write_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commits; the first is tried with wrong values, then fails half-way, then succeeds; all are read back."""
    frames_of = staging.line_frames(spark, sf_dir)
    samples, _ = pack.pack_frames(frames_of, ["observation.state", "observation.line", "action"])
    root = staging.fresh(spark, "samples")
    even = samples.where("episode_id % 2 = 0")
    sink.write_samples(even.withColumn("t_ns", F.lit(0).cast("bigint")), root, "even")
    try:
        sink.write_samples(_fails_midway(even, F.col("step") % 97 == 41), root, "even")
    except PySparkException as e:
        if "broken on purpose" not in str(e):
            raise
    sink.write_samples(even, root, "even")
    sink.write_samples(samples.where("episode_id % 2 <> 0"), root, "odd")
    stored = sink.committed(spark, root, samples.schema)
    total = F.aggregate(F.col("value").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return stored.groupBy("commit", "episode_id", "key", "slot").agg(
        _count(), F.max("step").alias("last_step"), F.max("t_ns").alias("last_t_ns"),
        F.round(F.sum(total), 3).alias("total"), F.sum(F.size("value")).alias("numbers"),
    )


@query(
    "pack_series_issues",
    """SELECT NULL AS recording_id, 'sensors' AS slot, 'observation.absent' AS item, 'column_absent' AS reason
    UNION ALL SELECT NULL, 'sensors', 'observation.flag', 'column_type type=string'
    UNION ALL SELECT l_suppkey::VARCHAR, 'sensors', 'observation.ragged', 'row_length row=49 found=1 expected=2'
    FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY l_suppkey HAVING count(*) >= 50""",
)
def pack_series_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, issues = pack.pack_frames(staging.line_frames(spark, sf_dir), _DECLARED)
    return issues


@query(
    "ragged_check",
    """WITH e AS (
      SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos,
             CASE WHEN vec_id % 40 = 13 THEN NULL WHEN vec_id % 60 = 31 THEN 3 ELSE 64 END AS size, label % 3 = 0 AS clean FROM embeddings),
    s AS (SELECT label, pos, CASE WHEN clean THEN 64 ELSE coalesce(size, 0) END AS len, NOT clean AND size IS NULL AS gone FROM e),
    f AS (SELECT label, arg_min(len, pos) AS first_len, bool_or(gone AND pos = 0) AS first_gone FROM s GROUP BY 1)
    SELECT label, CASE WHEN bool_or(first_gone) THEN 'row_length row=0 found=0 expected=0'
             WHEN count(*) FILTER (len <> first_len) > 0 THEN 'row_length row=' || min(pos) FILTER (len <> first_len) || ' found='
               || arg_min(len, pos) FILTER (len <> first_len) || ' expected=' || any_value(first_len) END AS reason
    FROM s JOIN f USING (label) GROUP BY label""",
)
def ragged_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = number_rows(B.table(spark, sf_dir, "embeddings"), ["label"], ["vec_id"], out="pos")
    k = F.col("vec_id")
    uneven = F.when(k % 40 == 13, None).when(k % 60 == 31, F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))
    value = F.when(F.col("label") % 3 == 0, F.col("embedding")).otherwise(uneven)
    out = quality.ragged_columns(vec.withColumn("v", value), ["label"], "v", "pos")
    return out.select("label", "reason")


# ── archives and lists ───────────────────────────────────────────────


@query(
    "scan_npz",
    """SELECT 'conv_' || conv_id AS name, '/talk/n_chars' AS key, count(*) AS n, max(turn) * 1000000000 AS last_t_ns,
              sum(length(text))::DOUBLE AS total, NULL AS reason FROM conversations GROUP BY conv_id
    UNION ALL SELECT 'conv_' || conv_id, '/talk/_t_ns', count(*), max(turn) * 1000000000, sum(turn)::DOUBLE * 1e9, NULL
    FROM conversations GROUP BY conv_id
    UNION ALL SELECT 'conv_' || conv_id, 'schema', 1, NULL, NULL, 'scalar array has no steps' FROM conversations GROUP BY conv_id
    UNION ALL SELECT 'conv_' || conv_id, '/meta/labels', 1, NULL, NULL, 'refused' FROM conversations GROUP BY conv_id""",
)
def scan_npz(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = B.table(spark, sf_dir, "conversations")
    blocks = talks.groupBy("conv_id", F.expr("turn div 1000").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("turn", F.length("text").alias("n_chars")))).alias("steps")
    )
    name = F.concat(F.lit("block="), F.col("block").cast("string"), F.lit("/conv_"), F.col("conv_id").cast("string"))
    root = staging.fresh(spark, "npz")
    # The work is in the files, not in the bytes that small partitions are joined by.
    dealt = blocks.repartition(spark.sparkContext.defaultParallelism * 4, "conv_id", "block")
    staging.archives(dealt.select(name.alias("name"), "steps"), root)
    samples, issues = arrays.scan_npz(spark, root)
    stem = r"(conv_\d+)\.npz$"
    good = samples.groupBy(F.regexp_extract("path", stem, 1).alias("name"), "key").agg(
        _count(),
        F.max(F.coalesce("t_ns", F.col("value")[0].cast("bigint"))).alias("last_t_ns"),
        F.sum(F.col("value")[0]).alias("total"),
        F.lit(None).cast("string").alias("reason"),
    )
    bad = issues.groupBy(
        F.regexp_extract("recording_id", stem, 1).alias("name"),
        F.col("item").alias("key"),
        F.substring_index("reason", ":", 1).alias("reason"),
    ).agg(_count())
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    "scan_csv_actions",
    """SELECT u.key, count(*) AS n, sum(l_linenumber::BIGINT * 1000000000)::BIGINT AS clock, round(sum(u.x::FLOAT::DOUBLE), 3) AS total
       FROM lineitem, LATERAL (VALUES ('cmd_vx/value', l_quantity), ('cmd_vy/value', l_discount), ('gripper_target/value', l_tax)) u(key, x)
       GROUP BY 1""",
)
def scan_csv_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staging.fresh(spark, "csv")
    B.table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("double").alias("t_s"),
        F.col("l_quantity").alias("cmd_vx"),
        F.col("l_discount").alias("cmd_vy"),
        F.col("l_tax").alias("gripper_target"),
    ).write.option("header", True).csv(root)
    rows = arrays.scan_csv_actions(spark, root, ["cmd_vx", "cmd_vy", "gripper_target"])
    return rows.groupBy("key").agg(
        _count(),
        F.sum("t_ns").alias("clock"),
        F.round(F.sum(F.col("value")[0].cast("double")), 3).alias("total"),
    )


@query(
    "baseline_ids",
    """SELECT o_orderkey::VARCHAR AS baseline_episode_id, o_orderpriority AS policy_version FROM orders
       WHERE o_orderkey % 10 NOT IN (3, 4)""",
)
def baseline_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = k.cast("string")
    line = (
        F.when(k % 10 == 3, "   ")
        .when(k % 10 == 4, F.concat(F.lit("# "), text))
        .when(k % 10 == 5, F.concat(F.lit("  "), text, F.lit(" ")))
        .otherwise(text)
    )
    root = staging.fresh(spark, "ids")
    B.table(spark, sf_dir, "orders").select(line.alias("line")).write.text(root)
    ids = arrays.baseline_ids(spark, root)
    eps = B.episodes(spark, sf_dir).select(
        F.col("episode_id").cast("string").alias("baseline_episode_id"), "policy_version"
    )
    return eps.join(ids, "baseline_episode_id", "left_semi")


# ── demonstrations ───────────────────────────────────────────────────

_BLOCK = 64


def _demo_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as demonstration steps: a file per supplier, a demo per line number.

    Suppliers with a key divisible by 5 hold one trajectory in the other layout.
    """
    values = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    # Rows are numbered by the keys that the names are made of, so no text is shuffled or sorted, and few columns are stored.
    demo = F.when(F.col("l_suppkey") % 5 != 0, F.col("l_linenumber"))
    lines = B.table(spark, sf_dir, "lineitem").withColumn("_demo", demo)
    order = [c for c in B.LINE_ORDER if c != "l_suppkey"]
    steps = number_rows(lines, ["l_suppkey", "_demo"], order, keep=["l_suppkey", "_demo", *values])
    return steps.select(
        F.concat(F.lit("file_"), F.col("l_suppkey").cast("string")).alias("path"),
        (F.col("l_suppkey") % 5 == 0).alias("single"),
        F.concat(F.lit("demo_"), F.col("_demo").cast("string")).alias("demo"),
        "step",
        *values,
    )


def _demo_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(datasets, attrs)``; every block of a dataset has at most 64 rows."""
    steps = _demo_steps(spark, sf_dir).withColumn("row_start", F.expr(f"(step div {_BLOCK}) * {_BLOCK}"))
    row = F.struct("step", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    blocks = steps.groupBy("path", "single", "demo", "row_start").agg(F.sort_array(F.collect_list(row)).alias("r"))
    lengths = steps.groupBy("path", "demo").agg(F.count(F.lit(1)).alias("t"))
    full = blocks.join(
        lengths, (blocks["path"] == lengths["path"]) & blocks["demo"].eqNullSafe(lengths["demo"])
    ).drop(lengths["path"]).drop(lengths["demo"])
    t = F.col("t")

    def dataset(name: Column, kind: str, size: int, shape: list, data: Column) -> Column:
        return F.struct(
            name.alias("name"),
            F.lit(kind).alias("kind"),
            F.lit(size).alias("itemsize"),
            F.array(*[x if isinstance(x, Column) else F.lit(x) for x in shape]).cast("array<bigint>").alias("shape"),
            data.cast("array<double>").alias("data"),
        )

    def pick(robomimic: str, single: str) -> Column:
        return F.when(F.col("single"), single).otherwise(robomimic)

    first = F.col("row_start") == 0
    nothing = F.lit(None).cast("array<double>")
    base = F.array(
        dataset(pick("actions", "action"), "f", 8, [t, 2], F.flatten(F.transform("r", lambda s: F.array(s["l_quantity"], s["l_tax"])))),
        dataset(pick("obs/robot0_eef_pos", "observations/qpos"), "f", 8, [t, 1], F.transform("r", lambda s: s["l_discount"])),
        dataset(F.lit("rewards"), "f", 8, [t], F.transform("r", lambda s: s["l_extendedprice"])),
        dataset(F.lit("dones"), "i", 8, [t], F.transform("r", lambda s: (s["step"] == t - 1).cast("double"))),
    )
    images = F.array(
        dataset(pick("obs/agentview_image", "observations/images/top"), "u", 1, [t, 12, 16, 3], nothing),
        dataset(pick("obs/depth_map", "observations/images/flat"), "f", 4, [t, 4], nothing),
        dataset(F.lit("states"), "f", 4, [0, 32], nothing),
    )
    datasets = full.select(
        "path", "demo", "row_start", F.inline(F.concat(base, F.when(first, images).otherwise(F.array())))
    )
    per_file = steps.groupBy("path").agg(F.max("single").alias("single"))
    env = '{"env_name":"Lift","env_kwargs":{"robots":["Panda"],"control_freq":20}}'
    file_attrs = F.when(F.col("single"), F.lit('{"sim":false}')).otherwise(
        F.to_json(F.struct(F.lit(env).alias("env_args")))
    )
    attrs = per_file.select(
        "path",
        F.lit(None).cast("string").alias("demo"),
        F.parse_json(file_attrs).alias("attrs"),
    ).unionByName(
        # Odd demos declare their length, two short of what is stored.
        lengths.where(F.col("demo").isNotNull() & F.col("demo").rlike("[13579]$")).select(
            "path",
            "demo",
            F.parse_json(F.format_string('{"num_samples":%d}', F.col("t") - 2)).alias("attrs"),
        )
    )
    return datasets, attrs


_DEMO_SQL = """demo_steps AS (
  SELECT 'file_' || l_suppkey AS path, l_suppkey % 5 = 0 AS single,
         CASE WHEN l_suppkey % 5 <> 0 THEN 'demo_' || l_linenumber END AS demo, l_linenumber, l_quantity, l_tax, l_discount, l_extendedprice,
         row_number() OVER (PARTITION BY l_suppkey, CASE WHEN l_suppkey % 5 <> 0 THEN l_linenumber END
           ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS step
  FROM lineitem),
lengths AS (
  SELECT path, demo, single, CASE WHEN demo IS NOT NULL AND l_odd THEN CASE WHEN t > 2 THEN t - 2 ELSE t END ELSE t END AS length, t
  FROM (SELECT path, demo, single, bool_and(l_linenumber % 2 = 1) AS l_odd, count(*) AS t FROM demo_steps GROUP BY ALL))"""


@query(
    "h5_layout",
    "SELECT DISTINCT 'file_' || l_suppkey AS path, CASE WHEN l_suppkey % 5 = 0 THEN 'single' ELSE 'robomimic' END AS layout FROM lineitem",
)
def h5_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demos.layout(_demo_tables(spark, sf_dir)[0])


@query("h5_length", f"WITH {_DEMO_SQL} SELECT path, demo, length FROM lengths")
def h5_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demos.trajectory_lengths(*_demo_tables(spark, sf_dir))


@query(
    "h5_summary",
    f"""WITH {_DEMO_SQL}
    SELECT path, CASE WHEN bool_or(single) THEN 'single' ELSE 'robomimic' END AS layout, count(*) AS total_episodes,
           sum(length)::BIGINT AS total_steps,
           CASE WHEN bool_or(single) THEN 'action,dones,observations/images/flat,observations/images/top,observations/qpos,rewards,states'
                ELSE 'actions,dones,obs/agentview_image,obs/depth_map,obs/robot0_eef_pos,rewards,states' END AS datasets,
           CASE WHEN bool_or(single) THEN 'observations/images/top' ELSE 'obs/agentview_image' END AS cameras,
           CASE WHEN bool_or(single) THEN 30.0 ELSE 20.0 END::DOUBLE AS fps, bool_or(single) AS fps_assumed,
           CASE WHEN bool_or(single) THEN 'real' ELSE 'Panda' END AS robot_type,
           CASE WHEN bool_or(single) THEN NULL ELSE 'Lift' END AS env_name
    FROM lengths GROUP BY path""",
)
def h5_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demos.file_summary(*_demo_tables(spark, sf_dir))


@query(
    "pack_h5",
    f"""WITH {_DEMO_SQL}
    SELECT path, demo, CASE WHEN single THEN 'action/value' ELSE 'actions/value' END AS key, 'actions' AS slot, count(*) AS n,
           max(step) * 50000000 AS last_t_ns, round(sum(l_quantity::FLOAT::DOUBLE + l_tax::FLOAT::DOUBLE), 3) AS total
    FROM demo_steps GROUP BY path, demo, single
    UNION ALL SELECT path, demo, CASE WHEN single THEN 'observations/qpos/value' ELSE 'obs/robot0_eef_pos/value' END, 'sensors', count(*),
           max(step) * 50000000, round(sum(l_discount::FLOAT::DOUBLE), 3) FROM demo_steps GROUP BY path, demo, single""",
)
def pack_h5(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets, _ = _demo_tables(spark, sf_dir)
    samples = pack.pack_demos(datasets, F.lit(20.0))
    total = F.aggregate(F.col("value").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return samples.groupBy("path", "demo", "key", "slot").agg(
        _count(), F.max("t_ns").alias("last_t_ns"), F.round(F.sum(total), 3).alias("total")
    )


@query(
    "outcome_h5",
    f"""WITH {_DEMO_SQL}
    SELECT path, demo, arg_max(l_extendedprice, step) AS rewards, 1.0::DOUBLE AS dones, round(sum(l_extendedprice), 3) AS reward_sum
    FROM demo_steps GROUP BY path, demo""",
)
def outcome_h5(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets, _ = _demo_tables(spark, sf_dir)
    out = outcomes.demo_outcomes(datasets)
    return out.select(
        "path",
        "demo",
        F.col("outcome")["rewards"].alias("rewards"),
        F.col("outcome")["dones"].alias("dones"),
        F.round("reward_sum", 3).alias("reward_sum"),
    )


@query(
    "report_dataset",
    """WITH e AS (SELECT conv_id, conv_id // 4 AS path, count(*) AS length FROM conversations GROUP BY ALL),
    t AS (SELECT path, count(*) AS total_episodes, sum(length)::BIGINT AS total_frames FROM e GROUP BY 1),
    f AS (SELECT DISTINCT conv_id // 4 AS path, 'observation.' || role AS name FROM conversations),
    lines AS (
      SELECT path, 0 AS a, 0 AS b, path || '  (v2.1, 30.0 fps)' AS line FROM t
      UNION ALL SELECT path, 1, 0, '  episodes: ' || total_episodes || ', frames: ' || total_frames FROM t
      UNION ALL SELECT path, 2, 0, '  cameras: observation.images.top' FROM t
      UNION ALL SELECT path, 3, 0, '  features: ' || string_agg(name, ', ' ORDER BY name) FROM f GROUP BY path
      UNION ALL SELECT path, 4, conv_id, '  ep ' || conv_id || ': ' || length || ' frames, task='''
        || CASE WHEN conv_id % 2 = 0 THEN 'talk' ELSE '(no task)' END || '''' FROM e JOIN t USING (path) WHERE total_episodes <= 5)
    SELECT path, row_number() OVER (PARTITION BY path ORDER BY a, b) - 1 AS line_no, line FROM lines""",
)
def report_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = B.table(spark, sf_dir, "conversations").withColumn("path", F.expr("conv_id div 4"))
    eps = talks.groupBy("path", F.col("conv_id").alias("episode_index")).agg(F.count(F.lit(1)).alias("length"))
    eps = eps.withColumn("task", F.when(F.col("episode_index") % 2 == 0, "talk"))
    spoken = talks.select("path", F.concat(F.lit("observation."), F.col("role")).alias("name"))
    fixed = talks.select(
        "path", F.explode(F.array(F.lit("observation.images.top"), F.lit("timestamp"))).alias("name")
    )
    features = spoken.unionByName(fixed).distinct().withColumn(
        "dtype", F.when(F.col("name") == "observation.images.top", "video").otherwise("float32")
    )
    info = eps.select("path").distinct().select(
        "path",
        F.lit("v2.1").alias("codebase_version"),
        F.lit(30.0).alias("fps"),
        F.lit(0).cast("bigint").alias("total_episodes"),
        F.lit(None).cast("bigint").alias("total_frames"),
    )
    return frames.dataset_report(frames.dataset_summary(info, eps), features, eps, short=True)


@query(
    "report_file",
    f"""WITH {_DEMO_SQL},
    s AS (SELECT path, bool_or(single) AS single, count(*) AS n FROM lengths GROUP BY path)
    SELECT path, unnest([0, 1, 2, 3, 4, 5, 6]) AS line_no,
           unnest(CASE WHEN single THEN [path, '  layout: single', '  trajectories: ' || n, '  fps: 30.0 (assumed)', '  robot_type: real',
             '  cameras: observations/images/top', '  datasets: action, dones, observations/images/flat, observations/images/top, observations/qpos, rewards, states']
           ELSE [path, '  layout: robomimic', '  trajectories: ' || n, '  fps: 20.0', '  robot_type: Panda', '  env: Lift',
             '  cameras: obs/agentview_image'] END) AS line FROM s
    UNION ALL SELECT path, 7, '  datasets: actions, dones, obs/agentview_image, obs/depth_map, obs/robot0_eef_pos, rewards, states' FROM s WHERE NOT single""",
)
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demos.file_report(demos.file_summary(*_demo_tables(spark, sf_dir)))


@query(
    "h5_episodes",
    f"""WITH {_DEMO_SQL}
    SELECT path, demo, length, row_number() OVER (
      PARTITION BY path ORDER BY coalesce(regexp_extract(demo, '_([0-9]+)$', 1)::BIGINT, 0), demo) - 1 AS "index" FROM lengths""",
)
def h5_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demos.episode_refs(demos.trajectory_lengths(*_demo_tables(spark, sf_dir)))
