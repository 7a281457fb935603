"""Trees grown over binned rows, held against plain searches of every node."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmotion.operators import boosting, models

FEATURES = ["a", "b", "c"]
SETTINGS = {**models.LAG_SETTINGS, "trees": 4, "depth": 6, "rows": 1.0, "columns": "all"}


@pytest.fixture
def rows(spark):
    rng = np.random.default_rng(5)
    n = 3000
    a, b, c = rng.normal(size=n), rng.integers(0, 9, n).astype(float), rng.random(n)
    x = np.sin(3 * a) * b + 4 * c + rng.normal(size=n) / 4
    y = np.where(b > 4, a, -a) * 2 + rng.normal(size=n) / 4
    table = list(zip(*(v.tolist() for v in (a, b, c, x, y, (np.arange(n) % 5 == 0)))))
    return spark.createDataFrame(table, "a double, b double, c double, x double, y double, held boolean")


def searched(values, target, cuts, node, tree, depth):
    """Checks that every node is split where the squares fall most; the fitted values."""
    if not len(target):
        return target
    here = ((target - target.mean()) ** 2).sum()
    assert tree.stats[node] == pytest.approx([len(target), target.sum(), (target**2).sum()], rel=1e-6, abs=1e-6)
    falls = {}
    for f, own in enumerate(cuts):
        for c, cut in enumerate(own):
            left = values[:, f] <= cut
            if left.any() and not left.all():
                falls[f, c] = here - sum(((t - t.mean()) ** 2).sum() for t in (target[left], target[~left]))
    best = max(falls.values(), default=0)
    if tree.feature[node] < 0:
        assert depth == 0 or best <= 1e-9 * (target**2).sum()
        return np.full(len(target), target.mean())
    assert depth > 0 and falls[tree.feature[node], tree.cut[node]] == pytest.approx(best)
    left = values[:, tree.feature[node]] <= cuts[tree.feature[node]][tree.cut[node]]
    out = np.empty(len(target))
    out[left] = searched(values[left], target[left], cuts, 2 * node + 1, tree, depth - 1)
    out[~left] = searched(values[~left], target[~left], cuts, 2 * node + 2, tree, depth - 1)
    return out


@pytest.mark.parametrize("alone", [0, 10_000])
def test_every_node_is_split_where_the_squares_fall_most(spark, rows, monkeypatch, alone):
    monkeypatch.setattr(boosting, "ALONE_ROWS", alone)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 700)
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 256)
    monkeypatch.setattr(boosting, "TASK_ROWS", 500)
    trees, cuts = boosting.grow(rows.coalesce(2), FEATURES, ["x", "y"], SETTINGS)
    assert [len(own) for own in trees] == [4, 4] and len(cuts[1]) == 9
    table = np.array([tuple(r) for r in rows.select(*FEATURES, "x", "y").collect()])
    values = table[:, :3]
    for own, target in zip(trees, table[:, 3:].T):
        lack = target.copy()
        for i, tree in enumerate(own):
            fitted = searched(values, lack * (2 if i else 1), cuts, 0, tree, 6)
            lack -= (0.05 if i else 1.0) * fitted
    model = models._fitted(models._pipeline(FEATURES, "y", "y", SETTINGS, None), trees[1], cuts)
    scored = model.transform(rows).select("y", "pred_y").collect()
    assert np.array([r.y - r.pred_y for r in scored]) == pytest.approx(lack)


@pytest.mark.parametrize("alone, most", [(0, 10 * 3 + 12), (10_000, 12)])
def test_a_fit_takes_a_pass_a_level_for_both_targets(spark, rows, monkeypatch, alone, most):
    """Jobs of a fit: before, each target had its own for every level, over rows that had to be cached whole."""
    monkeypatch.setattr(boosting, "ALONE_ROWS", alone)
    context = spark.sparkContext
    context.setJobGroup(f"fit-{alone}", "fit")
    try:
        models.fit_axes(rows, FEATURES, settings={**SETTINGS, "trees": 10, "depth": 3})
        jobs = len(context.statusTracker().getJobIdsForGroup(f"fit-{alone}"))
    finally:
        context._jsc.clearJobGroup()
    assert jobs <= most


def test_shares_of_rows_and_columns(spark, rows):
    settings = {**SETTINGS, "rows": 0.5, "columns": "0.34"}
    trees, _ = boosting.grow(rows, FEATURES, ["x", "y"], settings)
    again, _ = boosting.grow(rows, FEATURES, ["x", "y"], settings)
    counts = [tree.stats[0, 0] for own in trees for tree in own]
    assert all(1300 < n < 1700 for n in counts) and len(set(counts)) > 1
    assert {int(f) for own in trees for tree in own for f in tree.feature[tree.feature >= 0]} == {0, 1, 2}
    assert all(np.array_equal(p.feature, q.feature) for one, two in zip(trees, again) for p, q in zip(one, two))


@pytest.mark.parametrize("alone", [0, 10_000])
def test_held_out_rows_stop_each_target(spark, rows, monkeypatch, alone):
    monkeypatch.setattr(boosting, "ALONE_ROWS", alone)
    settings = {**SETTINGS, "trees": 30, "depth": 2, "step": 0.5}
    stopped = models.fit_axes(rows, FEATURES, settings=settings, validation="held")
    assert 1 <= min(stopped.n_trees()) and max(stopped.n_trees()) < 30
    held = rows.where("held")
    whole = boosting.grow(rows.where("NOT held"), FEATURES, ["x", "y"], settings)[0]
    assert stopped.x.stages[-1].trees[0].numNodes == (whole[0][0].feature >= 0).sum() * 2 + 1
    errors = stopped.x.stages[-1].evaluateEachIteration(stopped.x.stages[0].transform(held), "squared")
    assert errors[-1] == min(errors)


def test_refuses_no_rows_and_keeps_constant_targets(spark, rows):
    with pytest.raises(ValueError):
        models.fit_axes(rows.where("a > 99"), FEATURES, settings=SETTINGS)
    flat = rows.withColumns({"x": F.lit(2.5), "a": F.lit(None).cast("double")})
    model = models.fit_axes(flat, FEATURES, settings=SETTINGS)
    assert model.x.stages[-1].trees[0].numNodes == 1
    assert model.transform(flat.na.fill(0.0)).where("abs(pred_x - 2.5) > 1e-9").count() == 0
