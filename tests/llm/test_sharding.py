from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np

from runlens.llm import sharding
from tests.llm import brute


def jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_same_shards_as_one_key_at_a_time():
    keys = np.arange(2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shards in (1, 2, 24, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [jump(int(k), shards) for k in keys]


def test_slots_are_gapless_and_growth_moves_rows_into_the_new_shard_only(spark):
    df = spark.range(5000).selectExpr("id - 2500 AS k", "id AS slot").repartition(7)
    rows = sharding.assign(df, "k", 24).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(rows) == 5000 and all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {24} and 100 < len(moved) < 320
    again = {r.k: r.shard for r in sharding.assign(df.repartition(3), "k", 24).collect()}
    assert again == {r.k: r.shard for r in rows}
    assert max(Counter(r.shard for r in rows).values()) < 300


def test_missing_and_repeated_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None,), (None,), (7,), (7,), (8,)], "k long")
    rows = sharding.assign(df, "k", 3).collect()
    assert len({r.shard for r in rows if r.k is None}) == 1 and len({r.shard for r in rows if r.k == 7}) == 1
    assert sharding.assign(df.limit(0), "k", 3).count() == 0


def test_query_on_awkward_documents(spark, tmp_path):
    rows = brute.awkward_documents(3)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in sharding.op6_jump_hash(spark, str(tmp_path)).collect()}
    for d, t in rows:
        data = (t or "").encode()
        key = int(sharding.mixed(np.array([d], np.int64))[0])
        assert (got[d].size, got[d].text_crc32, got[d].law) == (len(data) + 8, zlib.crc32(data), "key")
        assert (got[d].shard, got[d].grown_shard) == (jump(key, 24), jump(key, 25))
