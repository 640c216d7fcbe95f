from __future__ import annotations

import math

import numpy as np
import pytest

from runlens.operators import metrics

SERIES = "episode_id STRING, key STRING, step BIGINT, value ARRAY<DOUBLE>"


def table(spark, series):
    """Rows from ``{(episode, key): [vector or None, ...]}``."""
    rows = [
        (ep, key, i, None if v is None else [float(x) for x in v])
        for (ep, key), values in series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, SERIES)


def l2_of(spark, base, cand):
    out = metrics.action_l2(table(spark, base), table(spark, cand)).collect()
    return {r["episode_id"]: r["action_l2"] for r in out}


def ood_of(spark, base, cand):
    out = metrics.ood_share(table(spark, base), table(spark, cand)).collect()
    return {r["episode_id"]: r["ood_share"] for r in out}


K = "/cmd_vel/linear"


def test_identical_actions_have_no_distance(spark):
    base = {("a", K): [[1, 2, 3]] * 4}
    assert l2_of(spark, base, base) == {"a": 0.0}


def test_unit_offset_gives_one(spark):
    got = l2_of(spark, {("a", K): [[0, 0, 0]] * 5}, {("a", K): [[1, 0, 0]] * 5})
    assert got == {"a": 1.0}


def test_namespace_fallback_only_when_key_is_absent(spark):
    base = {("a", "/grip/value"): [[1.0]] * 3, ("b", "/grip/value"): [[1.0]] * 3}
    cand = {
        ("a", "/grip"): [[3.0]] * 3,
        ("b", "/grip"): [[3.0]] * 3,
        ("b", "/grip/value"): [None] * 3,
    }
    assert l2_of(spark, base, cand) == {"a": 2.0, "b": None}


def test_steps_stop_at_the_shortest_baseline_key(spark):
    base = {("a", "/x/v"): [[0.0]] * 4, ("a", "/y/v"): [[0.0]] * 2}
    cand = {("a", "/x/v"): [[1.0], [1.0], [9.0], [9.0]]}
    assert l2_of(spark, base, cand) == {"a": 1.0}


def test_unequal_widths_and_clock_series_are_skipped(spark):
    base = {("a", "/x/v"): [[0.0, 0.0]] * 2, ("a", "/x/_t_ns"): [[5.0]] * 1, ("a", "plain"): [[0.0]] * 2}
    cand = {("a", "/x/v"): [[1.0]] * 2, ("a", "plain"): [[4.0]] * 2}
    assert l2_of(spark, base, cand) == {"a": None}


def test_everything_far_out_counts(spark):
    got = ood_of(spark, {("a", K): [[0, 0, 0]] * 100}, {("a", K): [[20, 20, 20]] * 10})
    assert got == {"a": 1.0}


def test_inliers_and_short_baselines(spark):
    rng = np.random.default_rng(1)
    base = {("a", K): rng.normal(size=(200, 3)), ("b", K): [[0.0]] * 4}
    cand = {("a", K): [[0.1, 0.1, 0.1]] * 20, ("b", K): [[0.0]] * 4}
    assert ood_of(spark, base, cand) == {"a": 0.0, "b": None}


def test_width_mismatch_counts_as_inside_and_nan_never_raises_the_maximum(spark):
    base = {("a", K): [[float(i % 3), 0.0] for i in range(9)]}
    cand = {("a", K): [[0.0], [math.nan, 99.0], [99.0, 0.0], [1.0, 0.0]]}
    assert ood_of(spark, base, cand) == {"a": 0.25}


def test_no_namespace_fallback_for_outliers(spark):
    base = {("a", "/grip/value"): [[1.0]] * 9}
    assert ood_of(spark, base, {("a", "/grip"): [[50.0]] * 9}) == {"a": None}


def brute_l2(base, cand):
    keys = {k: v for k, v in base.items() if "/" in k and not k.endswith("/_t_ns")}
    steps = []
    for i in range(min(len(v) for v in keys.values())):
        parts = []
        for k, v in keys.items():
            at = {c: w[i] for c, w in cand.items() if i < len(w)}
            other = at[k] if k in at else at.get(k.rsplit("/", 1)[0])
            if other is not None and len(other) == len(v[i]):
                parts.append(sum((x - y) ** 2 for x, y in zip(v[i], other)))
        if parts:
            steps.append(math.sqrt(sum(parts)))
    return sum(steps) / len(steps) if steps else None


def brute_ood(base, cand):
    stats = {
        k: (np.mean(v, axis=0), np.where(np.std(v, axis=0) < 1e-9, 1.0, np.std(v, axis=0)))
        for k, v in base.items()
        if "/" in k and len(v) >= 5
    }
    flags = []
    for i in range(max(len(v) for v in cand.values())):
        worst = None
        for k, (mean, std) in stats.items():
            v = cand.get(k, [])
            if i >= len(v) or v[i] is None:
                continue
            z = np.abs((np.array(v[i]) - mean) / std).max() if len(v[i]) == len(mean) else 0.0
            worst = max(worst or 0.0, z)
        if worst is not None:
            flags.append(worst > 3)
    return sum(flags) / len(flags) if flags else None


def test_random_episodes_agree_with_brute_force(spark):
    rng = np.random.default_rng(7)
    base, cand = {}, {}
    for e in range(25):
        for k in ("/a/x", "/a/y", "/b/z")[: rng.integers(1, 4)]:
            width = int(rng.integers(1, 4))
            base.setdefault(f"e{e}", {})[k] = rng.normal(size=(int(rng.integers(3, 12)), width)).tolist()
            name = k if rng.random() < 0.6 else k.rsplit("/", 1)[0]
            other = width if rng.random() < 0.8 else width + 1
            scale = 1 if rng.random() < 0.5 else 6
            cand.setdefault(f"e{e}", {})[name] = (scale * rng.normal(size=(int(rng.integers(1, 14)), other))).tolist()

    def flat(side):
        return {(e, k): v for e, d in side.items() for k, v in d.items()}

    l2, ood = l2_of(spark, flat(base), flat(cand)), ood_of(spark, flat(base), flat(cand))
    for e in base:
        for got, want in ((l2[e], brute_l2(base[e], cand[e])), (ood[e], brute_ood(base[e], cand[e]))):
            assert (got is None) == (want is None)
            if want is not None:
                assert got == pytest.approx(want, abs=1e-9)


def test_observations_stop_at_the_shortest_series(spark):
    sensors = table(spark, {("a", "/p/v"): [[1.0], [2.0], [3.0]], ("a", "/q/v"): [[7.0], [8.0]]})
    got = {r["step"]: r["obs"] for r in metrics.materialize_steps(sensors).collect()}
    assert got == {0: {"/p/v": [1.0], "/q/v": [7.0]}, 1: {"/p/v": [2.0], "/q/v": [8.0]}}
