from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import types as T

from runlens.streaming import live

SCHEMA = "recording_id BIGINT, t_ns BIGINT, seq BIGINT, is_stop BOOLEAN, exc_type STRING, exc_message STRING"
SECOND = 1_000_000_000


def arrivals(spark, folder, batches, schema):
    """One file for each batch, in order of time."""
    import os
    import time

    for k, rows in enumerate(batches):
        before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for f in set(os.listdir(folder)) - before:
            os.utime(f"{folder}/{f}", times=(time.time() - 1000 + k,) * 2)
    return live.file_stream(spark, folder, T.StructType.fromDDL(schema), files_per_batch=1)


def recordings():
    rng = random.Random(12)
    rows, seq = [], 0
    for rec in range(12):
        times = sorted(rng.sample(range(1, 900), 40))
        for t in times:
            seq += 1
            rows.append((rec, t * SECOND, seq, False, None, None))
        for t in rng.sample(range(1, 900), rng.choice([0, 1, 1, 3])):
            seq += 1
            failed = rng.random() < 0.5
            rows.append((rec, t * SECOND, seq, True, "ValueError" if failed else None, f"at {t}" if failed and rng.random() < 0.5 else None))
    rows.append((50, 7 * SECOND, seq + 1, True, None, None))  # stopped without a message
    return rows


def plain_closing(rows):
    out = {}
    for rec in {r[0] for r in rows}:
        stops = sorted((r[1], r[2], r[4], r[5]) for r in rows if r[0] == rec and r[3])
        times = [r[1] for r in rows if r[0] == rec and not r[3]]
        if stops and any(t <= stops[0][0] for t in times):
            within = [t for t in times if t <= stops[0][0]]
            reason = ": ".join(x for x in stops[0][2:] if x)
            meta = {"mode": "live", **({"failure_reason": reason} if reason else {})}
            status = "failed" if stops[0][2] else "ready"
            out[rec] = (status, len(within), len(times) - len(within), (max(within) - min(within)) / 1e9, meta)
    return out


def splits():
    rows = recordings()
    rng = random.Random(4)
    by_time = sorted(rows, key=lambda r: r[1])
    yield "in order", [by_time[k * 110 : (k + 1) * 110] for k in range(5)]
    near = sorted(rows, key=lambda r: r[1] + rng.randrange(200) * SECOND)
    yield "some late", [near[k * 55 : (k + 1) * 55] for k in range(10)]
    anyhow = rows[:]
    rng.shuffle(anyhow)
    yield "anyhow", [anyhow[k::7] for k in range(7)]


@pytest.mark.parametrize(("name", "batches"), list(splits()))
@pytest.mark.parametrize("salts", [1, 3])
def test_closing_does_not_depend_on_batches(spark, tmp_path, name, batches, salts):
    rows = [r for b in batches for r in b]
    delay = "250 seconds" if name != "anyhow" else "1000 seconds"
    clock = [(None, 10_000 * SECOND, -1, None, None, None)]
    stream = arrivals(spark, str(tmp_path / "in"), [*batches, clock], SCHEMA)
    live.append_rows(live.closed_recordings(stream, delay, salts), str(tmp_path / "out"), str(tmp_path / "cp"))
    closed = spark.read.schema(live.CLOSED).parquet(str(tmp_path / "out"))
    got = {r["recording_id"]: tuple(r)[1:] for r in live.finalized(closed).collect()}
    want = plain_closing(rows)
    assert {k: (*v[:3], round(v[3], 6), v[4]) for k, v in got.items()} == {k: (*v[:3], round(v[3], 6), v[4]) for k, v in want.items()}


def test_metadata_of_the_user_wins(spark):
    closed = spark.createDataFrame([(1, 0, 3, 1, 10, 20, 30, "ValueError", "bad")], live.CLOSED)
    given = spark.createDataFrame([(1, {"mode": "mine"})], "recording_id BIGINT, metadata MAP<STRING, STRING>")
    row = live.finalized(closed, given).first()
    assert (row["status"], row["metadata"]) == ("failed", {"mode": "mine", "failure_reason": "ValueError: bad"})


def test_late_rows_of_150_batches(spark, tmp_path):
    rng = random.Random(1)
    out = str(tmp_path / "out")
    schema = "seq BIGINT, ts TIMESTAMP"
    start = datetime.datetime(2024, 1, 1)
    write = live.late_splitter(out, 20_000)
    latest, want, seq = None, set(), 0
    for k in range(150):
        rows = []
        for _ in range(4):
            seq += 1
            at = start + datetime.timedelta(seconds=5 * k - rng.choice([0, 1, 10, 30, 60]), microseconds=rng.randrange(1_000_000))
            rows.append((seq, at))
            if latest is not None and at <= latest.replace(microsecond=latest.microsecond // 1000 * 1000) - datetime.timedelta(seconds=20):
                want.add(seq)
        latest = max([t for _, t in rows] + ([latest] if latest else []))
        batch = spark.createDataFrame(rows, schema)
        write(batch, k)
        if k % 40 == 3:
            write(batch, k)  # tried again
    done = live.split_rows(spark, out, T.StructType.fromDDL(schema))
    assert done.count() == seq
    assert {r["seq"] for r in done.where("late").collect()} == want and len(want) > 50


def test_unknown_topics_fail_before_the_start(spark):
    known = spark.createDataFrame([("/a",)], "topic STRING")
    stream = spark.createDataFrame([("/a", 1), ("/b", 2)], "topic STRING, n INT")
    assert live.ingest(stream, known, ["/a"]).count() == 1
    with pytest.raises(ValueError, match="/zz"):
        live.ingest(stream, known, ["/a", "/zz"])
    with pytest.raises(ValueError):
        live.ingest(stream, known, [])


def test_counts_come_from_the_state_of_several_batches(spark, tmp_path):
    rows = [(i % 3, f"/t{i % 2}") for i in range(300)]
    stream = arrivals(spark, str(tmp_path / "in"), [rows[k * 60 : (k + 1) * 60] for k in range(5)], "recording_id BIGINT, topic STRING")
    query = live.drain(live.topic_counts(stream), None, str(tmp_path / "cp"), "update")
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 5
    got = sorted(map(tuple, live.held_counts(spark, str(tmp_path / "cp")).collect()))
    assert got == sorted((r, t, rows.count((r, t))) for r, t in set(rows))


def test_the_last_result_of_each_key_is_held_once(spark, tmp_path):
    rng = random.Random(2)
    rows = [("run", k % 20, rng.random(), seq) for seq, k in enumerate(rng.sample(range(400), 400))]
    again = rows[100:300] + rows[:50]
    stream = arrivals(spark, str(tmp_path / "in"), [rows[:150], rows[150:], again[:90], again[90:], rows[-3:]], "run STRING, base BIGINT, reward DOUBLE, seq BIGINT")
    live.drain(live.latest_results(stream, ["run", "base"], ["seq"]), None, str(tmp_path / "cp"), "update")
    held = live.held_results(spark, str(tmp_path / "cp"))
    assert held.columns == ["run", "base", "reward", "seq"]
    want = {}
    for r in rows:
        want[r[1]] = r
    assert sorted(map(tuple, held.collect())) == sorted(want.values())


def test_a_call_closes_many_recordings(spark, tmp_path, monkeypatch):
    """Rows of 400 recordings in 4 buckets reach the state in as many keys, not one for each recording; a missing id is one too."""
    big = 1 << 60  # not a floating number's neighbour
    rows = [(big + r, t * SECOND, 10 * r + t, False, None, None) for r in range(400) for t in (1, 2, 9)]
    rows += [(big + r, 5 * SECOND, 10 * r + 5, True, "ValueError", f"at {r}") for r in range(400)]
    rows += [(None, 3 * SECOND, 7000, False, None, None), (None, 4 * SECOND, 7001, True, None, None)]
    clock = [(None, 10_000 * SECOND, -1, None, None, None)]
    stream = arrivals(spark, str(tmp_path / "in"), [rows, clock], SCHEMA)
    live.append_rows(live.closed_recordings(stream, "100 seconds", 1, buckets=4), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r["recording_id"]: tuple(r)[1:4] for r in live.finalized(spark.read.schema(live.CLOSED).parquet(str(tmp_path / "out"))).collect()}
    assert got == {big + r: ("failed", 2, 1) for r in range(400)} | {None: ("ready", 1, 0)}
    held = spark.read.format("statestore").option("stateVarName", "recordings").load(str(tmp_path / "cp"))
    assert held.count() <= 5


@pytest.mark.parametrize("rows_per_file", [100, 1_000_000])
def test_arrivals_have_as_many_files_as_their_rows_need(spark, tmp_path, rows_per_file):
    from runlens.plans import live as plans

    start = datetime.datetime(2024, 1, 1)
    rows = [(k, start + datetime.timedelta(minutes=k), k % 7, "view", 1.0, "{}") for k in range(3000)]
    schema = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    inbox, found, files = plans._inbox(spark, str(tmp_path), rows_per_file)
    assert files == (5 if rows_per_file == 100 else 1)
    stream = live.file_stream(spark, inbox, found, files_per_batch=files)
    sizes = []
    live.drain(stream, lambda batch, _: sizes.append((batch.count(), batch.rdd.getNumPartitions())), str(tmp_path / "cp"))
    part = [min(4, k * 5 * 60_000_000 // (2999 * 60_000_000 + 1) + (k % 7 == 0)) for k in range(3000)]
    assert [n for n, _ in sizes] == [part.count(p) for p in range(5)]


def test_pushed_results_are_written_by_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    import os

    from runlens.plans import live as plans

    written = []
    monkeypatch.setattr(plans, "ROWS_PER_FILE", 300)
    fresh = plans.staging.fresh
    monkeypatch.setattr(plans.staging, "fresh", lambda s, purpose: written.append(fresh(s, purpose)) or written[-1])
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    got = plans.stream_result_upsert(spark, "/root/testdata/sf0.001")
    assert got.count() == lines.select("l_returnflag", "l_suppkey").distinct().count()
    assert len([f for f in os.listdir(written[0].removeprefix("file://")) if f.endswith(".parquet")]) > 2 * plans.BATCHES
