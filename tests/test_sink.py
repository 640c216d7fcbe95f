from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from runlens.operators import sink

SAMPLES = "episode_id INT, slot STRING, key STRING, step BIGINT, value ARRAY<FLOAT>"


def samples(spark, n=400):
    return spark.range(n).select(
        (F.col("id") % 5).cast("int").alias("episode_id"),
        F.when(F.col("id") % 2 == 0, "sensors").otherwise("actions").alias("slot"),
        F.concat(F.lit("k"), F.col("id") % 3).alias("key"),
        F.col("id").alias("step"),
        F.array(F.col("id").cast("float")).alias("value"),
    )


def bag(df):
    return sorted(map(str, df.collect()))


def test_a_failed_try_is_never_seen_and_the_next_one_counts(spark, tmp_path):
    root = str(tmp_path / "t")
    df = samples(spark)
    broken = df.withColumn("step", F.when(F.col("step") == 333, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("step")))
    with pytest.raises(PySparkException, match="stop"):
        sink.write_samples(broken, root, "one")
    assert sink.committed(spark, root, df.schema).count() == 0
    sink.write_samples(df, root, "one")
    assert bag(sink.committed(spark, root, df.schema).drop("commit").select(*df.columns)) == bag(df)
    with pytest.raises(PySparkException, match="stop"):
        sink.write_samples(broken, root, "one")
    assert sink.committed(spark, root, df.schema).count() == 400


def test_the_last_try_of_a_name_wins_and_names_add_up(spark, tmp_path):
    root = str(tmp_path / "t")
    df = samples(spark)
    sink.write_samples(df.limit(50), root, "one")
    sink.write_samples(df.where("episode_id = 1"), root, "one")
    sink.write_samples(df.where("episode_id = 2"), root, "two")
    found = {r["commit"]: (r["seq"], r["rows"]) for r in sink.commits(spark, root).collect()}
    assert found == {"one": (1, 80), "two": (0, 80)}
    stored = sink.committed(spark, root, df.schema)
    assert {(r["commit"], r["episode_id"]) for r in stored.select("commit", "episode_id").distinct().collect()} == {("one", 1), ("two", 2)}
    assert sink.committed(spark, root, df.schema, ["two"]).count() == 80
    assert sink.committed(spark, root, df.schema, []).count() == 0
    with pytest.raises(ValueError, match="name"):
        sink.commit(df, root, "a/b")


def test_samples_are_parted_by_slot_and_ordered_in_their_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    monkeypatch.setattr(sink, "STEPS_PER_FILE", 100)
    sink.write_samples(samples(spark), root, "one")
    folder = f"{root}/{sink.commits(spark, root).first()['folder']}"
    assert {d for d in os.listdir(folder) if d.startswith("slot")} == {"slot=sensors", "slot=actions"}
    import pyarrow.parquet as pq

    for slot in ("sensors", "actions"):
        for name in os.listdir(f"{folder}/slot={slot}"):
            if name.endswith(".parquet"):
                rows = [(r["episode_id"], r["key"], r["step"]) for r in pq.read_table(f"{folder}/slot={slot}/{name}", partitioning=None).to_pylist()]
                assert rows == sorted(rows)


def test_an_empty_commit_and_the_catalogue(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = "episode_id INT, status STRING"
    sink.write_episodes(spark.createDataFrame([], schema), root, "a")
    assert sink.read_episodes(spark, root, schema).count() == 0
    sink.write_episodes(spark.createDataFrame([(1, "ready"), (2, None)], schema), root, "b")
    sink.write_episodes(spark.createDataFrame([(2, "failed")], schema), root, "c")
    got = {tuple(r) for r in sink.read_episodes(spark, root, schema).collect()}
    assert got == {(1, "ready", "b"), (2, "failed", "c")}
