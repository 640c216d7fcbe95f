"""Hard negatives and the cover tree against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import cover_tree, hard_negatives

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """Anchor by anchor over all rows, in whole numbers."""
    seen, width = set(), 0
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        q = tuple(math.floor(256 * float(np.float32(x))) for x in vector)
        width = max(width, len(q))
        seen.add((vec_id, label, q))
    seen = {(v, y, q + (0,) * (width - len(q))) for v, y, q in seen}
    last = lambda v: (v is None, v or 0)
    out = []
    for a, y, q in seen:
        if a is None or a % 100:
            continue
        score = lambda c: sum(x * z for x, z in zip(q, c))
        same = sorted((-score(c), last(v)) for v, z, c in seen if z == y and v != a)[:5]
        rest = sorted((-score(c), last(v)) for v, z, c in seen if z != y)
        for s, p in same:
            fits = [r for r in rest if 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, None if p[0] else p[1], k, None if v[0] else v[1], -s, -t) for k, (t, v) in enumerate(fits, 1)]
    return sorted(map(str, out))


def made(spark, rows, schema=ROWS):
    return sorted(str(tuple(r)) for r in hard_negatives.mine(spark.createDataFrame(rows, schema)).collect())


def clustered(n, seed, width=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (labels, width))
    label = rng.integers(0, labels, n)
    points = centres[label] + rng.normal(0, 0.25, (n, width)) + 0.2
    return [(k, [float(x) for x in p], int(y)) for k, (p, y) in enumerate(zip(points, label))]


@pytest.mark.parametrize(("block", "anchors"), [(4096, 8192), (37, 3)])
def test_against_all_rows(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", anchors)
    rows = clustered(900, 3)
    assert made(spark, rows) == plain(rows)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
    rng = random.Random(6)
    rows = clustered(500, 8, width=5)
    one = [0.5, 0.25, 0.0, -0.25, 0.125]
    rows += [(1000 + k, one, 2) for k in range(300)] + [(2000 + k, one, k % 3) for k in range(60)]  # a hot vector
    rows += rows[:40]  # repeated rows
    rows += [(None, one, 1), (None, one, 1), (None, [0.4] * 5, 2), (700, None, 1), (800, one, None), (900, [0.1, None, 0.2], 1)]
    rows += [(3000, [float("nan")] * 5, 1), (3100, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1), (3200, [], 1), (3300, [0.5, 0.5], 2), (3400, [0.0] * 5, 3)]
    rows += [(100, one, 3), (-100, [-x for x in one], 2), (-700, one, 9), (3500, [-0.3] * 5, 77)]
    rng.shuffle(rows)
    df = [(*r, "mine") for r in rows]
    got = made(spark, df, ROWS + ", rank string")
    assert got == plain(rows) and len(got) > 50


def test_few_rows_and_none(spark):
    assert made(spark, []) == []
    assert made(spark, [(100, [1.0], 1)]) == []
    pair = [(100, [1.0], 1), (101, [0.5], 1)]
    assert made(spark, pair) == []
    assert made(spark, pair + [(102, [0.45], 2)]) == plain(pair + [(102, [0.45], 2)]) != []


def test_scores_that_no_double_holds_fail(spark):
    rows = [(100, [1e12, 1.0], 1), (101, [1e12, 0.0], 1)]
    with pytest.raises(Exception, match="held exactly"):
        made(spark, rows)


@pytest.mark.parametrize("kind", ["spread", "equal", "line", "nested"])
def test_the_tree_covers_its_points_and_leaves_most_of_them_alone(kind):
    rng = np.random.default_rng(4)
    points = {
        "spread": lambda: rng.integers(-200, 200, (1500, 6)),
        "equal": lambda: np.tile([3, 4, 5], (900, 1)),
        "line": lambda: np.arange(1200)[:, None] * [1, 2],
        "nested": lambda: (np.sign(rng.normal(size=(1500, 4))) * 2 ** rng.integers(0, 9, (1500, 4))),
    }[kind]().astype(float)
    built = cover_tree.Tree(points)
    tree = cover_tree.Tree(points, built.packed())
    lifted = np.c_[points, np.sqrt(tree.top - (points**2).sum(1))]
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for c, r, a, b, child, n in tree.table:
        members = tree.order[int(a) : int(b)]
        assert np.linalg.norm(lifted[members] - lifted[int(c)], axis=1).max() <= r + 1e-3
        parts = tree.table[int(child) : int(child + n)]
        assert not n or (parts[0][2] == a and parts[-1][3] == b and all(x[3] == y[2] for x, y in zip(parts, parts[1:])))
    anchors = points[rng.integers(0, len(points), 40)]
    ids, zeros = np.arange(len(points)), np.zeros(len(points), np.int64)
    scores = anchors @ points.T
    windows = np.stack([np.stack([np.full(40, -np.inf), np.full(40, np.inf)], 1), np.stack([scores.max(1) * 0.5, scores.max(1) * 0.9], 1)], 1)
    found = cover_tree.Search(anchors, np.full(40, -1), zeros, windows, 5, True)
    found.visit(tree, ids, zeros)
    got = {}
    for a, w, s, i in zip(*found.rows()):
        got.setdefault((int(a), int(w)), []).append((-s, int(i)))
    for a in range(40):
        for w, (lo, hi) in enumerate(windows[a]):
            want = sorted((-s, i) for i, s in enumerate(scores[a]) if lo <= s <= hi)[:5]
            assert got.get((a, w), []) == want
    # How much is left alone depends on the points; equal ones and noise leave little to skip.
    if kind in ("line", "nested"):
        assert found.scored < {"line": 0.5, "nested": 0.6}[kind] * scores.size
