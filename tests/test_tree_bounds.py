"""A fold of 600,000 readings is boosted inside tasks; levels of many nodes are split a slice at a time."""

import numpy as np

from ferrite.operators import trees


def test_fold_of_600000_readings_is_a_group(monkeypatch):
    t = trees.Table(None, {0: []}, {0: (1.0, 1.0)}, {0: 384_000}, 0)
    monkeypatch.setattr(trees, "_boosted_in_groups", lambda t, jobs: "groups")
    monkeypatch.setattr(trees, "_boosted_in_passes", lambda t, jobs: "passes")
    assert trees.boosted_scores(t, [trees.Grown(0, 0, 5, stages=(100,))]) == "groups"


def test_slices_of_nodes_give_the_same_splits(monkeypatch):
    rng = np.random.default_rng(8)
    n, nodes = 4000, 37
    bins, at = rng.integers(0, trees.BINS, (n, 5)).astype(np.uint8), rng.integers(0, nodes, n)
    c, t = rng.integers(1, 4, n), (rng.random(n) > 0.7).astype(float)
    w = c * np.where(t > 0, 2.0, 0.5)
    totals = np.stack([np.bincount(at, v, nodes) for v in (c, w, w * t)], axis=1)
    for tried in (np.ones((nodes, 5), bool), rng.random((nodes, 5)) > 0.4):
        whole = trees.best_splits(trees.histograms(bins, at, nodes, c, w, w * t, tried), totals, tried, 3)
        monkeypatch.setattr(trees, "SLICE", 4)
        sliced = trees.level_splits(bins, at, totals, c, w, w * t, tried, 3)
        assert all(np.array_equal(a, b) for a, b in zip(whole, sliced))
