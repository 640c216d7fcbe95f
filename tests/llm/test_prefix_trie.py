"""The prefix trie and tree contraction against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from runlens.llm import contraction, prefix_trie

ROWS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    said = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, said(role or "", text or ""), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(xs)] for c, xs in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        stem = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(stem, [])[:h]) + tuple(own[h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += own
    ends = defaultdict(list)
    for c in sorted(rebuilt):
        ends[rebuilt[c]].append(str(c))
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else -1, len(m), len(children[n]) if n in children else 0, leaves[n], saved[n],
         hashlib.sha256(",".join(ends.get(n, [])).encode()).hexdigest())
        for n, m in members.items()
    )


def got(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in prefix_trie.prefix_trie(df).collect())


def test_against_a_plain_trie(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(-130, 330), 1000, 2005, 2017, 10**12 + 7]:
        n = rng.choice([1, 1, 2, 3, 5, 8, 40])
        rows += [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "é☃", "", None])) for t in range(n)]
    rows += [(0, t, "user", "same") for t in (1, 1, 1)] + [(None, 1, "user", "lost")] + rows[:7]
    rows += [(210, t, "user", f"turn {t % 3}") for t in range(700)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ROWS).repartition(5).withColumn("depth", F.lit("mine"))
    assert got(df) == plain_trie(rows)


def test_turnless_conversations_and_very_long_texts(spark):
    # Each has fewer turns than its head takes over, and no stem.
    few = [c for c in range(5001, 5099) if zlib.crc32(str(c).encode()) % 6 > 0]
    rows = [(c, 0, "user", "gone") for c in few] + [(7000, 0, "user", "x" * 2_000_000), (7000, 1, None, None)]
    want = plain_trie(rows)
    assert got(spark.createDataFrame(rows, ROWS)) == want
    assert want[0][3] == len(few) + 1


def test_an_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], ROWS)).count() == 0


def shape(kind):
    if kind == "path":
        return {k: k - 1 if k else None for k in range(700)}
    if kind == "star":
        return {k: 0 if k else None for k in range(3000)}
    if kind == "comb":
        return {k: None if k == 0 else (k - 2 if k % 2 == 0 else k - 1) for k in range(800)}
    if kind == "binary":
        return {k: (k - 1) // 2 if k else None for k in range(1000)}
    rng = random.Random(9)
    return {k: None if k < 3 else rng.randrange(max(0, k - 40), k) for k in range(1200)}


@pytest.mark.parametrize("kind", ["path", "star", "comb", "binary", "forest"])
def test_contraction_gives_every_subtree_total(spark, kind):
    parent = shape(kind)
    depth, total, mass = {}, {}, {}
    for k, p in parent.items():
        depth[k] = 0 if p is None else depth[p] + 1
        total[k], mass[k] = k + 1, 1
    for k in reversed(parent):
        if parent[k] is not None:
            total[parent[k]] += total[k]
            mass[parent[k]] += mass[k]
    rows = [(f"n{k}", None if p is None else f"n{p}", depth[k], k + 1, 1) for k, p in parent.items()]
    nodes = spark.createDataFrame(rows, "id string, parent string, level long, own long, one long")
    found = {r.id: (r.own, r.one) for r in contraction.subtree_totals(nodes, ["own", "one"]).collect()}
    assert found == {f"n{k}": (total[k], mass[k]) for k in parent}


def test_chains_halve_in_each_round(spark, monkeypatch):
    rounds = []
    real = contraction.compress
    monkeypatch.setattr(contraction, "compress", lambda *a: rounds.append(1) or real(*a))
    nodes = spark.range(1000).selectExpr("id", "IF(id = 0, NULL, id - 1) AS parent", "id AS level", "1L AS one")
    assert contraction.subtree_totals(nodes, ["one"]).filter("one = 1000 - id").count() == 1000
    assert len(rounds) <= 14
