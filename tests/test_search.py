"""Neighbour search and density clusters against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from gridmotion.operators import density, neighbors, pivots


def make_points(seed, groups, noise, dim=3, copies=0):
    rng, points = random.Random(seed), []
    for _ in range(groups):
        centre = [rng.uniform(-20, 20) for _ in range(dim)]
        for _ in range(25):
            points.append([c + rng.gauss(0, 0.6) for c in centre])
    points += [[rng.uniform(-40, 40) for _ in range(dim)] for _ in range(noise)]
    points += [[1.0] * dim] * copies
    return [(i, p) for i, p in enumerate(points)]


@pytest.mark.parametrize("shipped", [10**6, 1])
def test_knn_equals_brute_force(spark, shipped):
    points = make_points(2, 4, 10, copies=15)
    df = spark.createDataFrame(points, "id long, v array<double>").repartition(5)
    queries = df.where("id % 10 = 0")
    out = neighbors.knn(df, queries, 4, ["id"], "id", "v", max_shipped_values=shipped).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.id)
    for i, p in points:
        if i % 10 == 0:
            ranked = sorted(points, key=lambda t: (math.dist(p, t[1]), t[0]))
            assert got[i] == [t[0] for t in ranked[:4]]
    assert len(got) == len([1 for i, _ in points if i % 10 == 0])


def test_knn_by_key_finds_itself_and_rejects_unknown(spark):
    df = spark.createDataFrame(make_points(2, 2, 3), "id long, v array<double>")
    first = neighbors.nearest_by_key(df, {"id": 7}, 3, "v").first()
    assert (first.id, first.distance) == (7, 0.0)
    with pytest.raises(ValueError):
        neighbors.nearest_by_key(df, {"id": 999}, 3, "v")


def brute_clusters(points, eps, min_samples, min_size):
    near = {i: [j for j, q in points if math.dist(p, q) <= eps] for i, p in points}
    core = {i for i in near if len(near[i]) >= min_samples}
    label = {}
    for i in sorted(core):
        if i in label:
            continue
        stack = [i]
        while stack:
            a = stack.pop()
            if a not in label:
                label[a] = i
                stack += [b for b in near[a] if b in core and b not in label]
    where = dict(points)
    order = sorted(points, key=lambda t: (t[1], t[0]))
    rank = {}
    for i, p in order:
        rank[i] = len({tuple(q) for q in map(where.get, where) if q < p})
    for i, _ in points:
        if i not in core:
            options = [(math.dist(where[i], where[j]), rank[j], j) for j in near[i] if j in core]
            label[i] = label[min(options)[2]] if options else None
    sizes = {}
    for v in label.values():
        sizes[v] = sizes.get(v, 0) + 1
    return {i: v if v is not None and sizes[v] >= min_size else None for i, v in label.items()}


@pytest.mark.parametrize("block_rows", [512, 6])
def test_density_clusters_equal_brute_force(spark, block_rows):
    points = make_points(4, 5, 30, copies=20)
    df = spark.createDataFrame(points, "id long, v array<double>")
    out = density.density_clusters(df, ["id"], "v", 1.2, 5, 6, block_rows=block_rows).collect()
    want = brute_clusters(points, 1.2, 5, 6)
    assert len(out) == len(points)
    pairs = set()
    for r in out:
        assert (r.cluster == -1) == (want[r.id] is None)
        assert (r.cluster_prob == 0.0) if r.cluster == -1 else (0.0 <= r.cluster_prob <= 1.0)
        pairs.add((r.cluster, want[r.id]))
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    labels = sorted({r.cluster for r in out} - {-1})
    assert labels == list(range(len(labels)))


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + hub, "a long, b long")
    roots = {r.node: r.root for r in density.connected_components(edges).collect()}
    assert all(roots[i] == 0 for i in range(201))
    assert all(roots[1000 + i] == 1000 for i in range(300))


def test_found_rows_are_reduced_on_the_way(spark, monkeypatch):
    """Links of many block pairs shrink to a forest and one nearest core point each; clusters stay the same."""
    found = pd.DataFrame(
        [("edge", 5, 3, 0.0), ("edge", 5, 4, 0.0), ("edge", 4, 3, 0.0), ("edge", 9, 8, 0.0), ("border", 7, 5, 0.4), ("border", 7, 3, 0.2), ("border", 7, 4, 0.2)],
        columns=["kind", "a", "b", "distance"],
    )
    assert sorted(density._spanned(found).itertuples(index=False, name=None)) == [
        ("border", 7, 3, 0.2), ("edge", 4, 3, 0.0), ("edge", 5, 3, 0.0), ("edge", 9, 8, 0.0),
    ]
    df = spark.range(300).selectExpr("id", "array(CAST(id % 60 AS DOUBLE) / 4, CAST(id * 7 % 11 AS DOUBLE) * 3) AS v")
    clusters = lambda: sorted(map(tuple, density.density_clusters(df, ["id"], "v", 1.2, 3, 4, block_rows=16).collect()))
    want = clusters()
    monkeypatch.setattr(density, "HELD_ROWS", 1)
    monkeypatch.setattr(density, "GROUP_BLOCKS", 2)
    assert clusters() == want and len({c for _, c, _ in want}) > 1


def test_block_pairs_are_decided_as_by_differences():
    """Counts, links and nearest core points of two blocks, against all differences: sparse, dense, copies, at the radius."""
    from types import SimpleNamespace

    rng = np.random.default_rng(8)
    left, right = rng.normal(size=(90, 6)), rng.normal(size=(70, 6))
    right[:20] = left[:20]
    right[20:40] = left[20:40] + np.eye(6)[0]  # about at the radius 1
    left[5, 2], right[50, 1] = np.nan, np.inf
    l_core, r_core = rng.random(90) < 0.5, rng.random(70) < 0.5
    gaps = ((left[:, None] - right[None]) ** 2).sum(axis=2)
    for eps in (0.5, 1.0, 3.0, 9.0):
        near = gaps <= eps * eps
        pair = SimpleNamespace(same=False, l_vecs=left, r_vecs=right, l_pid=np.arange(90), r_pid=np.arange(100, 170))
        pair.l_flag, pair.r_flag = np.arange(1, 91), np.arange(1, 71)
        counts = dict(density._summed(pd.concat(density._count_kernel(eps)(pair))).itertuples(index=False))
        want = dict(zip(range(90), (near @ pair.r_flag).tolist())) | dict(zip(range(100, 170), (near.T @ pair.l_flag).tolist()))
        assert counts == {k: n for k, n in want.items() if n}
        pair.l_flag, pair.r_flag = l_core, r_core
        links = density._spanned(pd.concat(density._link_kernel(eps)(pair)))
        borders = links[links["kind"] == "border"].set_index("a")
        far = np.where(near, gaps, np.inf)
        for side, core, other, all_ids, at in ((far, l_core, r_core, range(90), 100), (far.T, r_core, l_core, range(100, 170), 0)):
            for i, own in zip(all_ids, side):
                best = np.where(other, own, np.inf)
                if not core[i % 100] and np.isfinite(best.min()):
                    assert borders.loc[i, "b"] == at + best.argmin() and np.isclose(borders.loc[i, "distance"], best.min() ** 0.5)
        joined = {(a, 100 + b) for a, b in zip(*np.nonzero(near & l_core[:, None] & r_core[None]))}
        root = {n: n for edge in joined for n in edge}
        for _ in root:
            for a, b in joined:
                root[a] = root[b] = min(root[a], root[b])
        edges = links[links["kind"] == "edge"]
        assert dict(zip(edges["a"], edges["b"])) == {n: r for n, r in root.items() if n != r}


def test_nearest_rows_within_a_known_distance():
    rng = np.random.default_rng(9)
    queries, rows = rng.normal(size=(40, 5)), np.repeat(rng.normal(size=(150, 5)), 2, axis=0)
    at, row, away = pivots.top_k_positions(queries, rows, 3)
    within = np.full(40, np.inf)
    parts = []
    for lo in range(0, 300, 50):
        found = pivots.top_k_positions(queries, rows[lo : lo + 50], 3, within)
        pivots.drawn_in(within, found[0], found[2], 3)
        parts.append((found[0], found[1] + lo, found[2]))
    each, place, gap = map(np.concatenate, zip(*parts))
    order = np.lexsort((place, gap, each))
    each, place, gap = each[order], place[order], gap[order]
    keep = np.arange(len(each)) - np.searchsorted(each, each) < 3
    assert np.array_equal(each[keep], at) and np.array_equal(place[keep], row) and np.array_equal(gap[keep], away)
    assert len(each) < 40 * 3 * 6  # later blocks tell less
