"""Pivot search and hierarchical clusters against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmotion.operators import hierarchy, neighbors, pivots


def clustered(n, seed, width=4, centres=6, noise=10):
    """Rows around centres; one of `noise` lies anywhere."""
    rng = np.random.default_rng(seed)
    middle = rng.uniform(-50, 50, (centres, width))
    rows = middle[rng.integers(0, centres, n)] + rng.normal(0, 1.5, (n, width))
    rows[: n // noise] = rng.uniform(-60, 60, (n // noise, width))
    return np.round(rows, 3)


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, vector array<double>").repartition(3)


def all_distances(rows):
    return np.sqrt(((rows[:, None, :] - rows[None, :, :]) ** 2).sum(axis=2))


def test_neighbours_by_pivots_are_exact_and_prune(spark):
    rows = clustered(3000, 1, centres=12, noise=200)
    rows[50:60] = rows[49]  # copies tie at distance 0
    df = frame(spark, rows)
    picked = pivots.pick_pivots(df, "vector", len(rows), 64)
    blocks = pivots.block_vectors(df, ["id"], "vector", picked, 64)
    assert blocks.intervals.agg(F.sum("n"), F.max("n")).first()[:] == (3000, 64)
    found, pairs = pivots.nearest_rows(blocks, blocks, 7)
    assert pivots.share_met(pairs, blocks, blocks) < 0.3
    assert found.count() <= 2 * 7 * len(rows)  # however many blocks a query met
    best = {}
    for r in found.collect():
        best.setdefault(r["query_id"], []).append((r["distance"], r["id"]))
    away = all_distances(rows)
    for i in range(len(rows)):
        want = sorted(zip(away[i].tolist(), range(len(rows))))[:7]
        got = sorted(best[i])[:7]
        assert [g[1] for g in got] == [w[1] for w in want] and np.allclose([g[0] for g in got], [w[0] for w in want])


def test_neighbours_by_pivots_on_few_rows(spark):
    df = frame(spark, np.array([[0.0, 0.0], [3.0, 4.0], [0.0, 0.0]]))
    got = neighbors.knn(df, df, 5, ["id"], "id", max_shipped_values=0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["id"], r["distance"]) for r in got] == [
        (0, 0, 0.0), (0, 2, 0.0), (0, 1, 5.0), (1, 1, 0.0), (1, 0, 5.0), (1, 2, 5.0), (2, 0, 0.0), (2, 2, 0.0), (2, 1, 5.0),
    ]
    none = df.where("false")
    assert neighbors.knn(none, df, 5, ["id"], "id", max_shipped_values=0).count() == 0


# ------------------------------------------------------- clusters, top down on all pairs


def brute_clusters(rows, min_cluster_size, min_samples):
    """[(cluster, probability)] by cutting the spanning tree from its longest edge down."""
    points = sorted({tuple(r) for r in rows.tolist()})
    number = {p: i for i, p in enumerate(points)}
    owner = [number[tuple(r)] for r in rows.tolist()]
    weight = np.bincount(owner)
    away = all_distances(np.array(points))
    core = []
    for i in range(len(points)):
        line = np.repeat(away[i], weight)
        core.append(np.sort(line)[min(min_samples, len(line) - 1)])
    edges = sorted(
        (max(away[i, j], core[i], core[j]), i, j) for i in range(len(points)) for j in range(i + 1, len(points))
    )
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    tree = []
    for w, i, j in edges:
        if find(i) != find(j):
            root[find(i)] = find(j)
            tree.append((w, i, j))
    density = lambda d: 1 / d if d > 0 else math.inf
    nodes = []  # parents first: birth, death, [(point, density)], children, size

    def grow(members, inside, birth):
        me = len(nodes)
        nodes.append([birth, None, [], [], sum(weight[list(members)])])
        while True:
            if len(members) == 1:
                (p,) = members
                nodes[me][1] = density(core[p])
                nodes[me][2].append((p, density(core[p])))
                return me
            w, i, j = inside[-1]
            inside = inside[:-1]
            near = {i}
            grown = True
            while grown:
                grown = False
                for _, a, b in inside:
                    if (a in near) != (b in near):
                        near |= {a, b}
                        grown = True
            sides = [near, members - near]
            large = [s for s in sides if sum(weight[list(s)]) >= min_cluster_size]
            if len(large) == 2:
                nodes[me][1] = density(w)
                for s in sides:
                    nodes[me][3].append(grow(s, [e for e in inside if e[1] in s], density(w)))
                return me
            for s in sides:
                if s not in large:
                    nodes[me][2] += [(p, density(w)) for p in s]
            if not large:
                nodes[me][1] = density(w)
                return me
            members = large[0]
            inside = [e for e in inside if e[1] in members]

    if sum(weight) >= min_cluster_size:
        grow(set(range(len(points))), tree, 0.0)
    value, picked = {}, set()
    for i in reversed(range(len(nodes))):
        birth, death, leaving, kids, size = nodes[i]
        own = sum(weight[p] * (d - birth) for p, d in leaving) + sum(nodes[k][4] * (death - birth) for k in kids)
        below = sum(value[k] for k in kids)
        if i and not below > own:
            picked.add(i)
        value[i] = max(own, below)
    out = {}

    def label(i, chosen):
        chosen = chosen if chosen is not None else i if i in picked else None
        for p, d in nodes[i][2]:
            if chosen is not None:
                end = nodes[chosen][1]
                out[p] = (chosen, 1.0 if math.isinf(d) else 0.0 if math.isinf(end) else min(d, end) / end)
        for k in nodes[i][3]:
            label(k, chosen)

    if nodes:
        label(0, None)
    order = {c: n for n, c in enumerate(sorted({c for c, _ in out.values()}, key=lambda c: min(p for p in out if out[p][0] == c)))}
    return [(order[out[p][0]], out[p][1]) if p in out else (-1, 0.0) for p in owner]


CASES = {
    "clustered": (clustered(500, 2), 12, 5, 32, 1_000_000),
    "edges in parts": (clustered(160, 3, 3, 3), 8, 3, 16, 25),
    "copies": (np.repeat(clustered(60, 4, 2, 3), [1, 1, 9] * 20, axis=0), 8, 4, 16, 1_000_000),
    "evenly spaced": (np.array([[float(i % 9), float(i // 9)] for i in range(81)]), 5, 3, 16, 20),
    "too few": (clustered(6, 5, 2, 1), 10, 3, 16, 1_000_000),
}


@pytest.mark.parametrize("name", CASES)
def test_hierarchical_clusters(spark, name):
    rows, min_cluster_size, min_samples, block_rows, at_once = CASES[name]
    order = list(range(len(rows)))
    random.Random(7).shuffle(order)
    rows = rows[order]
    got = hierarchy.hierarchical_clusters(
        frame(spark, rows), ["id"], "vector", min_cluster_size, min_samples, block_rows, at_once
    ).orderBy("id").collect()
    want = brute_clusters(rows, min_cluster_size, min_samples)
    assert [r["cluster"] for r in got] == [c for c, _ in want]
    assert np.allclose([r["cluster_prob"] for r in got], [p for _, p in want])
    if name == "clustered":
        assert len({c for c, _ in want}) > 3 and any(0 < p < 1 for _, p in want) and any(c < 0 for c, _ in want)


def test_rows_without_vectors_are_noise(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, vector array<double>")
    got = hierarchy.hierarchical_clusters(df, ["id"], min_cluster_size=2)
    assert sorted(map(tuple, got.collect())) == [(1, -1, 0.0), (2, -1, 0.0)]


def test_forest_rounds_store_a_block_once(spark, monkeypatch):
    rows = np.random.default_rng(3).integers(0, 9, (400, 3)).astype(float)  # many ties
    df = spark.createDataFrame([(v.tolist(),) for v in rows], "v array<double>")
    paths, scratch = [], hierarchy.scratch_path
    monkeypatch.setattr(hierarchy, "scratch_path", lambda *a: paths.append(scratch(*a)) or paths[-1])
    forest = hierarchy.spanning_forest(df, "v", 2, block_rows=32)
    points, counts = np.unique(rows, axis=0, return_counts=True)
    away = np.linalg.norm(points[:, None] - points[None], axis=2)
    core = np.array([np.sort(np.repeat(line, counts))[2] for line in away])
    reach = np.maximum(np.maximum(away, core[:, None]), core[None, :])
    near, weight = reach[0].copy(), 0.0
    near[0] = np.inf
    inside = np.arange(len(points)) == 0
    for _ in range(len(points) - 1):
        at = int(np.argmin(np.where(inside, np.inf, near)))
        inside[at], weight = True, weight + near[at]
        near = np.minimum(near, reach[at])
    assert np.isclose(sum(e["w"] for e in forest.edges.collect()), weight)
    rounds = [p for p in paths if p.endswith("round-blocks")]
    assert rounds and all(spark.read.parquet(p).select("block").distinct().count() == spark.read.parquet(p).count() for p in rounds)
