"""Rules over names, clocks, widths and JSON that are made of table values, with twins that decide on their own.

Inputs are SQL expressions that both engines evaluate alike; only the rule under
test is written twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions import classify, scalars, typed
from runlens.plans import bindings as B
from runlens.plans.registry import query
from runlens.sources import demos

# ── names ────────────────────────────────────────────────────────────

_COLUMN = """CASE p_size % 11
  WHEN 0 THEN 'observation.images.' || p_brand WHEN 1 THEN 'observation.' || p_brand WHEN 2 THEN 'action'
  WHEN 3 THEN 'action.' || lower(p_type) WHEN 4 THEN 'actions_' || p_brand WHEN 5 THEN 'next.' || lower(p_type)
  WHEN 6 THEN 'timestamp' WHEN 7 THEN 'Action.' || p_brand WHEN 8 THEN 'task_index' WHEN 9 THEN 'index' || p_brand
  ELSE p_name END"""


@query(
    "column_slots",
    f"""WITH n AS (SELECT p_partkey, {_COLUMN} AS name FROM part)
    SELECT p_partkey, name, CASE WHEN name IN ('timestamp', 'frame_index', 'episode_index', 'index', 'task_index') THEN 'internal'
             WHEN name LIKE 'observation.images.%' THEN 'video' WHEN name = 'action' OR name LIKE 'action.%' THEN 'actions'
             WHEN name LIKE 'next.%' THEN 'episode_meta' ELSE 'sensors' END AS slot,
           CASE WHEN name IN ('timestamp', 'frame_index', 'episode_index', 'index', 'task_index') THEN 'exact'
             WHEN regexp_matches(name, '^(observation\\.|next\\.|action\\.|action$)') THEN 'prefix' ELSE 'default' END AS reason
    FROM n""",
)
def column_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = B.table(spark, sf_dir, "part").select("p_partkey", F.expr(_COLUMN).alias("name"))
    return named.select("p_partkey", "name", classify.classify_column(F.col("name")).alias("c")).select("p_partkey", "name", "c.*")


_DATASET = """CASE p_size % 12
  WHEN 0 THEN 'obs/' || lower(p_type) || '_image' WHEN 1 THEN 'observations/images/' || p_brand WHEN 2 THEN 'actions'
  WHEN 3 THEN 'action_dict/' || p_brand WHEN 4 THEN 'actionable/' || p_brand WHEN 5 THEN 'data/Rewards'
  WHEN 6 THEN 'OBS/' || p_type || '_RGB' WHEN 7 THEN '/obs//depth_' || p_brand WHEN 8 THEN 'obs/action_' || lower(p_type)
  WHEN 9 THEN 'timestamps' WHEN 10 THEN 'action/' || p_name ELSE 'states/' || p_name END"""
_SHAPE = "p_partkey % 7 + 1, p_size, 4, p_partkey % 5"


@query(
    "dataset_slots",
    f"""WITH n AS (SELECT p_partkey, {_DATASET} AS name, [{_SHAPE}] AS shape, p_partkey % 3 AS k FROM part),
    p AS (SELECT *, list_filter(string_split(lower(name), '/'), lambda s: s <> '') AS parts FROM n),
    f AS (SELECT *, parts[-1] AS leaf, parts[1] AS root, k < 2 AND list_contains([1, 3, 4], shape[4]) AS camera FROM p),
    c AS (SELECT *, CASE WHEN leaf IN ('timestamp', 'timestamps', 'frame_index', 'episode_index', 'index') THEN 'internal'
             WHEN leaf LIKE 'action%' OR root = 'action' OR root LIKE 'action\\_%' ESCAPE '\\' THEN 'actions'
             WHEN leaf IN ('reward', 'rewards', 'done', 'dones', 'success', 'successes', 'discount', 'terminated', 'truncated') THEN 'episode_meta'
             WHEN list_contains(parts, 'images') OR regexp_matches(leaf, 'image|rgb|depth') THEN 'video' ELSE 'sensors' END AS said FROM f)
    SELECT p_partkey, name, said AS slot, camera, CASE WHEN said = 'video' AND NOT camera THEN 'sensors' ELSE said END AS used_as FROM c""",
)
def dataset_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the stacks hold bytes that are no unsigned numbers, a third floats."""
    k = F.col("p_partkey") % 3
    facts = B.table(spark, sf_dir, "part").select(
        "p_partkey", F.expr(_DATASET).alias("name"), F.expr(f"array({_SHAPE})").alias("shape"),
        F.when(k == 0, "u").when(k == 1, "i").otherwise("f").alias("kind"), F.when(k == 1, 1).otherwise(4).alias("itemsize"),
    )
    camera = classify.is_camera(F.col("shape"), F.col("kind"), F.col("itemsize"))
    used = classify.demo_slot(F.col("name"), F.col("shape"), F.col("kind"), F.col("itemsize"))
    return facts.select(
        "p_partkey", "name", classify.classify_dataset(F.col("name"))["slot"].alias("slot"), camera.alias("camera"), used.alias("used_as")
    )


_KEY = "CASE WHEN page_id % 5 = 0 THEN replace(url, '/', '.') WHEN page_id % 5 = 1 THEN url || '/_t_ns' ELSE url END"
_DTYPE = "CASE page_id % 6 WHEN 0 THEN 'bool' WHEN 1 THEN 'float32' WHEN 2 THEN 'int64' WHEN 3 THEN 'object' WHEN 4 THEN 'uint8' ELSE '<U8' END"


@query(
    "page_keys",
    f"""WITH k AS (SELECT page_id, {_KEY} AS key, {_DTYPE} AS dtype FROM pages)
    SELECT page_id, CASE WHEN contains(key, '/') THEN regexp_replace(key, '/[^/]*$', '') ELSE '' END AS ns,
           string_split(key, '/')[-1] AS field,
           contains(key, '/') AND NOT suffix(key, '/_t_ns') AND dtype IN ('float32', 'int64', 'uint8') AS used FROM k""",
)
def page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, dtype = F.expr(_KEY), F.expr(_DTYPE)
    return B.table(spark, sf_dir, "pages").select(
        "page_id", classify.key_namespace(key).alias("ns"), classify.key_field(key).alias("field"),
        classify.is_metric_key(key, dtype).alias("used"),
    )


_PATH = """url || CASE page_id % 9 WHEN 0 THEN '.mp4' WHEN 1 THEN '.MOV' WHEN 2 THEN '/run.npz' WHEN 3 THEN '.b.parquet'
  WHEN 4 THEN '.csv' WHEN 5 THEN '/.mp4' WHEN 6 THEN '.webm/raw' WHEN 7 THEN '.Feather' ELSE '' END"""


@query(
    "file_kinds",
    f"""WITH p AS (SELECT page_id, string_split({_PATH}, '/')[-1] AS name FROM pages),
    e AS (SELECT page_id, lower(regexp_extract(ltrim(name, '.'), '.(\\.[^.]*)$', 1)) AS ext FROM p)
    SELECT page_id, CASE WHEN ext IN ('.mp4', '.webm', '.mov', '.m4v') THEN 'video'
             WHEN ext IN ('.bin', '.npy', '.npz', '.h5', '.hdf5') THEN 'sensors'
             WHEN ext IN ('.parquet', '.feather', '.arrow') THEN 'actions' END AS kind FROM e""",
)
def file_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "pages").select("page_id", classify.kind_from_extension(F.expr(_PATH)).alias("kind"))


_VERSION = """CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CASE WHEN o_custkey % 5 = 0 THEN '' ELSE 'v' END
  || CAST(o_orderkey % 11 AS VARCHAR(9)) || '.' || CAST(o_custkey % 3 AS VARCHAR(9)) END"""


@query(
    "format_versions",
    f"""WITH v AS (SELECT o_orderkey, {_VERSION} AS version FROM orders)
    SELECT o_orderkey, version, CASE WHEN version IN ('v2.0', 'v2.1', 'v3.0', 'v3.1') OR prefix(coalesce(version, ''), 'v3') THEN 'ok'
             WHEN regexp_matches(coalesce(version, ''), '^v[4-9]') THEN 'newer' ELSE 'unknown' END AS status FROM v""",
)
def format_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = B.table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_VERSION.replace("VARCHAR(9)", "STRING")).alias("version"))
    return versions.withColumn("status", classify.format_support(F.col("version")))


_DEMO = """CASE o_custkey % 6 WHEN 0 THEN 'demo_' || o_orderkey WHEN 1 THEN 'demo' WHEN 2 THEN 'demo_' || o_orderpriority
  WHEN 3 THEN 'take_a_00' || o_custkey WHEN 4 THEN o_orderstatus || '_' || o_custkey || 'b' ELSE 'demo_' || o_custkey END"""


@query(
    "demo_ranks",
    f"""WITH d AS (SELECT o_orderkey, o_orderstatus, {_DEMO} AS key FROM orders),
    n AS (SELECT *, CASE WHEN regexp_matches(key, '_[0-9]+$') THEN regexp_extract(key, '_([0-9]+)$', 1)::BIGINT ELSE 0 END AS num FROM d)
    SELECT o_orderkey, key, num, row_number() OVER (PARTITION BY o_orderstatus ORDER BY num, key, o_orderkey) - 1 AS rank FROM n""",
)
def demo_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a demonstration of a file named by its status; ranks follow the natural order of keys."""
    from runlens.operators.ordering import number_rows

    keyed = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.expr(_DEMO).alias("key"))
    order = scalars.demo_order(F.col("key"))
    ranked = number_rows(keyed.withColumn("num", order["n"]), ["o_orderstatus"], ["num", "key", "o_orderkey"], out="rank")
    return ranked.select("o_orderkey", "key", "num", "rank")


# ── clocks ───────────────────────────────────────────────────────────

_USER_FPS = "CASE WHEN s_nationkey % 3 = 0 THEN NULL ELSE CAST(round(s_acctbal / 100) AS DOUBLE) END"
_FILE_FPS = "CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE CAST(s_nationkey - 5 AS DOUBLE) END"


@query(
    "fps_choices",
    f"""WITH f AS (SELECT s_suppkey, {_USER_FPS} AS u, {_FILE_FPS} AS f FROM supplier)
    SELECT s_suppkey, CASE WHEN u > 0 THEN u WHEN f > 0 THEN f ELSE 30.0 END::DOUBLE AS fps,
           NOT (coalesce(u, 0) > 0 OR coalesce(f, 0) > 0) AS assumed FROM f""",
)
def fps_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = scalars.resolve_fps(F.expr(_USER_FPS), F.expr(_FILE_FPS)).alias("p")
    return B.table(spark, sf_dir, "supplier").select("s_suppkey", picked).select("s_suppkey", "p.*")


_FROM, _TO, _RATE = "(l_linenumber - 2) * 0.5", "(l_linenumber - 2) * 0.5 + l_suppkey % 5 * 0.25 - 0.25", "CAST(l_quantity AS DOUBLE)"


@query(
    "clip_frames",
    f"""WITH c AS (SELECT l_linenumber, l_suppkey % 5 AS s, l_quantity, ({_FROM})::DOUBLE AS a, ({_TO})::DOUBLE AS b, {_RATE} AS r FROM lineitem),
    w AS (SELECT *, greatest(0, round_even(a * r, 0)::BIGINT) AS first FROM c)
    SELECT l_linenumber, s, l_quantity, first, greatest(round_even(b * r, 0)::BIGINT, first + 1) AS past, count(*) AS n FROM w GROUP BY ALL""",
)
def clip_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = scalars.clip_window(F.expr(_FROM).cast("double"), F.expr(_TO).cast("double"), F.expr(_RATE))
    return B.table(spark, sf_dir, "lineitem").groupBy(
        "l_linenumber", (F.col("l_suppkey") % 5).alias("s"), "l_quantity", window["start"].alias("first"), window["end"].alias("past")
    ).agg(F.count(F.lit(1)).alias("n"))


# ── payloads ─────────────────────────────────────────────────────────


def _some(n: Column, absent: Column) -> Column:
    """The first ``n`` components of a row's vector; missing where ``absent`` holds."""
    return F.when(~absent, F.slice("embedding", F.lit(1), n.cast("int")).cast("array<double>"))


@query(
    "joint_states",
    """WITH w AS (SELECT vec_id, vec_id % 5 AS np, CASE WHEN label % 3 <> 0 THEN label END AS nv,
                         CASE WHEN label % 4 <> 0 THEN (vec_id + label) % 5 END AS ne, CASE WHEN label % 2 = 0 THEN vec_id % 5 + (label = 4)::INT END AS nn
                  FROM embeddings)
    SELECT vec_id, CASE WHEN np = 0 THEN 'empty field=positions' ELSE concat_ws('|',
             CASE WHEN nv <> np THEN 'unequal field=velocities found=' || nv || ' expected=' || np END,
             CASE WHEN ne <> np THEN 'unequal field=efforts found=' || ne || ' expected=' || np END,
             CASE WHEN nn <> np THEN 'unequal field=names found=' || nn || ' expected=' || np END) END AS violations FROM w""",
)
def joint_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, label = F.col("vec_id"), F.col("label")
    names = _some(k % 5 + (label == 4).cast("int"), label % 2 != 0)
    found = typed.joint_state_violations(
        _some(k % 5, F.lit(False)), _some(label, label % 3 == 0), _some((k + label) % 5, label % 4 == 0), typed.to_strings(names)
    )
    return B.table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(found, "|").alias("violations"))


@query(
    "typed_vectors",
    """WITH w AS (
      SELECT vec_id, CASE WHEN label <> 1 THEN vec_id % 3 + 2 END AS a, CASE WHEN label <> 2 THEN label % 3 + 3 END AS b, list_max(embedding[1:3]) > 0.2 AS hole FROM embeddings),
    v AS (
      SELECT vec_id, u.* FROM w, LATERAL (VALUES
        ('pose', 1, 'translation', a, 3, false, hole), ('pose', 2, 'rotation', b, 4, false, false),
        ('twist', 1, 'linear', a, 3, false, hole), ('twist', 2, 'angular', b, 3, false, false),
        ('imu', 1, 'linear_acceleration', a, 3, false, hole), ('imu', 2, 'angular_velocity', a, 3, false, hole), ('imu', 3, 'orientation', b, 4, true, false)
      ) u(kind, i, field, n, want, optional, gap)),
    p AS (SELECT *, CASE WHEN n IS NULL THEN CASE WHEN NOT optional THEN 'absent field=' || field END
                         WHEN n <> want THEN 'width field=' || field || ' found=' || n || ' expected=' || want
                         WHEN gap THEN 'no_number field=' || field END AS problem FROM v)
    SELECT vec_id, coalesce(string_agg(problem, '|' ORDER BY i) FILTER (kind = 'pose'), '') AS pose,
           coalesce(string_agg(problem, '|' ORDER BY i) FILTER (kind = 'twist'), '') AS twist,
           coalesce(string_agg(problem, '|' ORDER BY i) FILTER (kind = 'imu'), '') AS imu FROM p GROUP BY vec_id""",
)
def typed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first vector of a row loses its first component where one of the first three exceeds 0.2."""
    k, label = F.col("vec_id"), F.col("label")
    holed = F.transform(_some(k % 3 + 2, label == 1), lambda x, i: F.when((i > 0) | (F.array_max(F.slice("embedding", 1, 3)) <= 0.2), x))
    other = _some(label % 3 + 3, label == 2)
    return B.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.array_join(typed.pose_violations(holed, other), "|").alias("pose"),
        F.array_join(typed.twist_violations(holed, other), "|").alias("twist"),
        F.array_join(typed.imu_violations(holed, holed, other), "|").alias("imu"),
    )


@query(
    "whole_vectors",
    """SELECT vec_id, CASE WHEN label = 3 THEN 'width field=v found=' || len(embedding) + 1 || ' expected=' || len(embedding)
                           WHEN list_max(embedding) > 0.35 THEN 'no_number field=v' END AS problem,
              round(list_sum(list_filter(embedding, lambda x: x <= 0.35))::DOUBLE, 4) AS total FROM embeddings""",
)
def whole_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component is looked at: those above 0.35 arrive as text that is no number; one label has a component too many."""
    told = F.transform("embedding", lambda x: F.when(x > 0.35, F.lit("high")).otherwise(x.cast("double").cast("string")))
    given = F.when(F.col("label") == 3, F.array_append(told, F.lit("0"))).otherwise(told)
    numbers = typed.to_floats(given)
    total = F.aggregate(F.filter(numbers, lambda x: x.isNotNull()), F.lit(0.0), lambda a, x: a + x)
    wide = F.size("embedding")
    rows = B.table(spark, sf_dir, "embeddings")
    width = rows.agg(F.max(wide)).first()[0] or 0
    return rows.select("vec_id", typed.vector_problem("v", numbers, width).alias("problem"), F.round(total, 4).alias("total"))


_ENV = """CASE WHEN s_nationkey % 6 = 0 THEN 'no json ' || s_name WHEN s_nationkey % 6 = 1 THEN '["' || s_name || '"]'
  ELSE '{"env_name":"' || s_name || '","env_kwargs":{"robots":' || CASE s_suppkey % 3 WHEN 0 THEN '"Arm' || s_nationkey || '"'
    WHEN 1 THEN '["Leg' || s_nationkey || '","Hand"]' ELSE '[]' END || ',"control_freq":' || CASE WHEN s_suppkey % 4 = 0 THEN '"20"' ELSE '' || (s_nationkey - 4) END || '}}' END"""


@query(
    "env_args",
    f"""SELECT s_suppkey, CASE WHEN ok THEN s_name END AS env_name,
           CASE WHEN ok THEN CASE s_suppkey % 3 WHEN 0 THEN 'Arm' || s_nationkey WHEN 1 THEN 'Leg' || s_nationkey END END AS robot_type,
           CASE WHEN ok AND s_suppkey % 4 <> 0 AND s_nationkey > 4 THEN (s_nationkey - 4)::DOUBLE END AS fps
    FROM (SELECT *, s_nationkey % 6 > 1 AS ok FROM supplier)""",
)
def env_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = demos.env_meta(F.expr(_ENV)).alias("e")
    return B.table(spark, sf_dir, "supplier").select("s_suppkey", found).select("s_suppkey", "e.*")
