"""Every registered query next to its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from runlens.plans import load
from tests.compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load()

# Nothing qualifies for these at the smallest size.
MAY_BE_EMPTY = {"field_consistency"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    ok, note = compare(spark, duck, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert ok or (name in MAY_BE_EMPTY and note.startswith("0 rows")), note


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["episode_id", "action_l2"]


@pytest.mark.parametrize("name", ["step_number", "infer_fps", "msg_deltas", "camera_frames", "rollout_totals", "ragged_check"])
def test_many_range_partitions_give_the_same_rows(spark, duck, name):
    """Groups then cross the borders of the ranges that rows are dealt by."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ok, note = compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_DIR)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert ok, note
