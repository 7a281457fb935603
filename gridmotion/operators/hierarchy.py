"""Hierarchical density clustering of vectors: every density level at once, no radius.

The core distance of a row is the distance to its min_samples-th other row. Two rows reach each
other at the largest of their distance and both core distances. A minimum spanning forest of
these reach distances is grown in Boruvka rounds: each component takes its shortest edge to
another one, and only pairs of blocks are compared that may hold an edge within what some
component already knows to be enough. The forest's edges in ascending order are the
single-linkage tree; it is condensed as it grows, since only components of min_cluster_size
rows are clusters. Of nested clusters those with more stability (row weights times the range of
densities they live through) are kept.

Exact copies are one point with a weight. Edges are handled EDGES_AT_ONCE at a time, lightest
first, so neither the driver nor a task holds the whole tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.operators.density import NOISE, connected_components
from gridmotion.operators.pivots import (
    BLOCK_ROWS,
    GROUP_BLOCKS,
    LANDMARKS,
    ROOM,
    PivotBlocks,
    block_vectors,
    distances,
    gap,
    matrix,
    nearest_rows,
    pick_pivots,
    read_blocks,
)
from gridmotion.operators.skew import dense_index
from gridmotion.session import checkpointed, scratch_path

EDGES_AT_ONCE = 1_000_000  # edges of the forest joined on the driver in one go, 24 MB
EDGES_HELD = 500_000  # edges a task gathers before it keeps the shortest of each component
HOOKS_AT_ONCE = 200_000  # components of a round that are joined on the driver; more by Spark
EDGE = "w double, lo long, hi long"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Forest:
    """points: pid, weight, core and the vector; edges: the spanning tree (w, lo, hi)."""

    points: DataFrame
    edges: DataFrame
    total: int


def core_distances(points: DataFrame, blocks: PivotBlocks, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """((pid, core), (a, b, d) of each point's nearest points, itself included)."""
    near = nearest_rows(blocks, blocks, min_samples + 1)[0].select(
        F.col("query_id").alias("a"), F.col("pid").alias("b"), F.col("distance").alias("d")
    )
    near = _written(near, "near")
    order = Window.partitionBy("a").orderBy("d", "b")
    # A point's own copies count as others; each point has one row at least.
    weighted = near.join(points.select(F.col("pid").alias("b"), "weight"), "b")
    ranked = weighted.withColumn("n", F.sum("weight").over(order)).withColumn("r", F.row_number().over(order))
    enough = F.min(F.when(F.col("n") >= min_samples + 1, F.col("d")))
    cores = ranked.groupBy("a").agg(F.coalesce(enough, F.max("d")).alias("core"))
    closest = ranked.where(F.col("r") <= min_samples + 1).select("a", "b", "d")
    return cores.withColumnRenamed("a", "pid"), closest


def _landmark_reach(members: DataFrame) -> DataFrame:
    """(comp, reach): an edge that leads out of each component is no longer than that.

    Two rows are no farther apart than over a landmark; each landmark's two nearest components
    are enough for all of them.
    """
    per = members.select("comp", "core", F.posexplode("marks").alias("mark", "away"))
    per = _written(per.groupBy("comp", "mark").agg(F.min(F.struct("away", "core")).alias("m")), "landmark-reach")
    order = Window.partitionBy("mark").orderBy("m.away", "m.core", "comp")
    two = per.withColumn("r", F.row_number().over(order)).where("r <= 2").collect()  # 2 rows a landmark
    best = {(r["mark"], r["r"]): (r["comp"], r["m"]["away"], r["m"]["core"]) for r in two}
    table = [
        (mark, best[mark, 1][0], *best[mark, 1][1:], *(best[mark, 2][1:] if (mark, 2) in best else (None, None)))
        for mark in {m for m, _ in best}
    ]
    spark = members.sparkSession
    tops = spark.createDataFrame(table, "mark int, first long, away1 double, core1 double, away2 double, core2 double")
    is_first = F.col("comp") == F.col("first")
    away, core = F.when(is_first, F.col("away2")).otherwise(F.col("away1")), F.when(is_first, F.col("core2")).otherwise(F.col("core1"))
    edge = F.when(away.isNotNull(), F.greatest(F.col("m.away") + away, F.col("m.core"), core))
    return per.join(F.broadcast(tops), "mark").groupBy("comp").agg(F.min(edge).alias("reach"))


def _least_edges(comp: np.ndarray, w: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """The shortest edge of each component, ties by the smaller points."""
    order = np.lexsort((hi, lo, w, comp))
    comp, w, lo, hi = comp[order], w[order], lo[order], hi[order]
    first = np.flatnonzero(np.r_[True, comp[1:] != comp[:-1]]) if len(comp) else np.zeros(0, int)
    return comp[first], w[first], lo[first], hi[first]


def _edges_between(left: tuple, right: tuple) -> list[tuple[np.ndarray, ...]]:
    """Of two blocks (pid, core, comp, vectors): each point's shortest edge out of its component, by component."""
    (l_pid, l_core, l_comp, l_vec), (r_pid, r_core, r_comp, r_vec) = left, right
    w = np.maximum(np.maximum(distances(l_vec, r_vec), l_core[:, None]), r_core[None, :])
    w[l_comp[:, None] == r_comp[None, :]] = np.inf
    lo, hi = np.minimum(l_pid[:, None], r_pid[None, :]), np.maximum(l_pid[:, None], r_pid[None, :])
    none, out = np.iinfo(np.int64).max, []
    for own, away, low, high in ((l_comp, w, lo, hi), (r_comp, w.T, lo.T, hi.T)):
        least = away.min(axis=1)
        hit = away == least[:, None]
        first = np.where(hit, low, none).min(axis=1)
        second = np.where(hit & (low == first[:, None]), high, none).min(axis=1)
        use = np.isfinite(least)
        out.append(_least_edges(own[use], least[use], first[use], second[use]))
    return out


def _edge_search(path: str):
    """A group of blocks, each with the blocks it meets: those pass by once, read from the shared folder."""

    def side(ids: pa.StructArray, vecs: pa.Array) -> tuple:
        return (*(ids.field(c).to_numpy(zero_copy_only=False) for c in ("pid", "core", "comp")), matrix(vecs))

    def search(group: pa.Table) -> pa.Table:
        lefts, asking = [], {}
        for i in range(group.num_rows):
            lefts.append(side(group.column("ids")[i].values, group.column("vecs")[i].values))
            for block in group.column("met")[i].as_py():
                asking.setdefault(block, []).append(i)
        found, held = [], 0
        for block, ids, vecs in read_blocks(path, asking):
            right = side(ids, vecs)
            for i in asking[block]:
                fresh = _edges_between(lefts[i], right)
                found += fresh
                held += sum(len(f[0]) for f in fresh)
            if held > EDGES_HELD:
                found, held = [_least_edges(*map(np.concatenate, zip(*found)))], 0
        kinds = (np.int64, np.float64, np.int64, np.int64)
        columns = _least_edges(*map(np.concatenate, zip(*found))) if found else [np.zeros(0, t) for t in kinds]
        return pa.Table.from_arrays([pa.array(c, pa.from_numpy_dtype(t)) for c, t in zip(columns, kinds)], ["comp", "w", "lo", "hi"])

    return search


def _shortest(points: DataFrame, blocks: PivotBlocks, members: DataFrame, near: DataFrame) -> DataFrame:
    """(comp, w, lo, hi): the shortest edge out of each component, ties by the smaller points."""
    comp_of = members.select("pid", "comp", "core")
    side = lambda s: comp_of.select(F.col("pid").alias(s), F.col("comp").alias(f"comp_{s}"), F.col("core").alias(f"core_{s}"))
    known = near.join(side("a"), "a").join(side("b"), "b").where("comp_a <> comp_b")
    edge = F.struct(F.greatest("d", "core_a", "core_b").alias("w"), F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    known = known.select("comp_a", "comp_b", edge.alias("e"))
    known = known.select(F.col("comp_a").alias("comp"), "e").union(known.select("comp_b", "e"))
    known = _written(known.groupBy("comp").agg(F.min("e").alias("e")), "known-edges")
    reach = _landmark_reach(members).join(known, "comp", "left").select(
        "comp", (F.least(F.coalesce("e.w", F.lit(float("inf"))), F.coalesce("reach", F.lit(float("inf")))) * (1 + ROOM)).alias("reach")
    )
    held = blocks.blocks.select("block", F.posexplode("ids").alias("at", "id")).select("block", "at", F.col("id.pid").alias("pid"))
    held = held.join(comp_of, "pid").join(reach, "comp")
    state = held.groupBy("block").agg(
        F.min("comp").alias("one"), F.max("comp").alias("other"), F.max("reach").alias("reach"), F.min("core").alias("least"),
        F.sort_array(F.collect_list(F.struct("at", "pid", "core", "comp"))).alias("m"),
    )  # fmt: skip  # a block's rows are bounded
    state = _written(state, "block-states")
    placed = blocks.intervals.join(state.drop("m"), "block")
    parts = placed.groupBy("part").agg(F.max("reach").alias("p_reach"), F.min("least").alias("p_least"))
    parts = parts.join(blocks.partitions(), "part")
    left = placed.select(*[F.col(c).alias(f"l_{c}") for c in placed.columns])
    lists = F.broadcast(parts.select("part", "p_reach", "p_least", F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi")))
    far = lambda lo, hi, least: F.greatest(gap(F.col("l_lo"), F.col("l_hi"), F.col(lo), F.col(hi)), "l_least", least)
    near_parts = left.join(lists, far("p_lo", "p_hi", "p_least") <= F.greatest("l_reach", "p_reach"))
    right = placed.select(F.col("part"), *[F.col(c).alias(f"r_{c}") for c in placed.columns if c != "part"])
    met = near_parts.join(right, "part").where(
        (F.col("l_block") <= F.col("r_block"))
        & (far("r_lo", "r_hi", "r_least") <= F.greatest("l_reach", "r_reach"))
        & ~((F.col("l_one") == F.col("l_other")) & (F.col("l_one") == F.col("r_one")) & (F.col("r_one") == F.col("r_other")))
    )
    pairs = _written(met.select("l_block", "r_block"), "edge-pairs")
    # Each block is stored once a round, with what its points know; a group of blocks reads those it meets.
    spark, folder = state.sparkSession, scratch_path(state.sparkSession, "round-blocks")
    known_blocks = state.select("block", F.col("m").alias("ids")).join(blocks.blocks.select("block", "vecs"), "block")
    known_blocks.write.parquet(folder)
    full = spark.read.schema(known_blocks.schema).parquet(folder)
    groups = max(spark.sparkContext.defaultParallelism, -(-state.count() // GROUP_BLOCKS))
    asked = pairs.groupBy(F.col("l_block").alias("block")).agg(F.collect_list("r_block").alias("met")).join(full, "block")
    asked = asked.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    found = asked.groupBy("group").applyInArrow(_edge_search(folder), "comp long, w double, lo long, hi long")
    every = found.select("comp", F.struct("w", "lo", "hi").alias("e")).union(known)
    return every.groupBy("comp").agg(F.min("e").alias("e")).select("comp", "e.w", "e.lo", "e.hi")


def _roots(hooks: DataFrame) -> DataFrame:
    """(node, root) of the components of hooks (a, b); few of them are joined on the driver."""
    hooks = _written(hooks, "hooks")
    some = hooks.limit(HOOKS_AT_ONCE + 1).collect()
    if len(some) > HOOKS_AT_ONCE:
        return connected_components(hooks)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in some:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return hooks.sparkSession.createDataFrame([(x, find(x)) for x in list(root)], "node long, root long")


def spanning_forest(df: DataFrame, vector: str, min_samples: int, block_rows: int = BLOCK_ROWS) -> Forest:
    """Distinct vectors with weight and core distance, and their minimum spanning tree."""
    distinct = df.where(F.col(vector).isNotNull()).groupBy(F.col(vector).cast("array<double>").alias("vec")).agg(
        F.count(F.lit(1)).alias("weight")
    )
    points = checkpointed(dense_index(distinct, ["vec"], "pid").select("pid", "vec", "weight"))
    spark, n = points.sparkSession, points.count()
    if not n:
        return Forest(points.withColumn("core", F.lit(0.0)), spark.createDataFrame([], EDGE), 0)
    total = points.agg(F.sum("weight")).first()[0]
    pivots = pick_pivots(points, "vec", n, block_rows)
    blocks = block_vectors(points, ["pid"], "vec", pivots, block_rows)
    cores, near = core_distances(points, blocks, min_samples)
    near = _written(near.where("a <> b"), "nearest")
    points = checkpointed(points.join(cores, "pid"))
    landmarks = pivots[:LANDMARKS]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = distances(matrix(batch.column("vec")), landmarks) if batch.num_rows else np.zeros((0, len(landmarks)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(away) + 1) * len(landmarks), pa.int32()), pa.array(away.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("pid"), batch.column("core"), lists], ["pid", "core", "marks"])

    marked = _written(points.select("pid", "core", "vec").mapInArrow(mark, "pid long, core double, marks array<double>"), "marked")
    labels, edges, left = marked.select("pid", F.col("pid").alias("comp")), None, n
    while left > 1:
        members = marked.join(labels, "pid")
        chosen = _written(_shortest(points, blocks, members, near), "chosen")
        new = chosen.select("w", "lo", "hi").distinct()
        edges = new if edges is None else edges.union(new)
        ends = labels.select(F.col("pid").alias("lo"), F.col("comp").alias("x")), labels.select(F.col("pid").alias("hi"), F.col("comp").alias("y"))
        hooks = new.join(ends[0], "lo").join(ends[1], "hi").select(F.col("x").alias("a"), F.col("y").alias("b"))
        roots = _roots(hooks)
        labels = checkpointed(
            labels.join(roots, F.col("comp") == F.col("node"), "left").select("pid", F.coalesce("root", "comp").alias("comp"))
        )
        left = labels.select("comp").distinct().count()
    edges = spark.createDataFrame([], EDGE) if edges is None else checkpointed(edges)
    return Forest(points, edges, total)


def _density(distance: float) -> float:
    return 1.0 / distance if distance > 0 else float("inf")


@dataclass
class CondensedTree:
    """Clusters in the order in which they form, as edges come in, lightest first.

    A cluster has one entry in every list: at most 2 rows / min_cluster_size of them.
    """

    least: int  # rows a cluster needs
    death: list[float] = field(default_factory=list)  # density at which it splits or dissolves
    birth: list[float] = field(default_factory=list)  # density at which it parts from its sister
    weight: list[int] = field(default_factory=list)
    summed: list[float] = field(default_factory=list)  # of the densities at which its rows leave it
    children: list[tuple[int, ...]] = field(default_factory=list)

    def form(self, density: float, weight: int, children: tuple[int, ...] = ()) -> int:
        self.death.append(density)
        self.birth.append(0.0)
        self.weight.append(weight)
        self.summed.append(weight * density)
        self.children.append(children)
        return len(self.death) - 1

    def join(self, sides: list[tuple[int, int | None]], w: float) -> tuple[int | None, list[bool]]:
        """(the cluster of two joined sides, if any; whether each side's rows leave it there).

        A side is its number of rows and its cluster, if it is large enough.
        """
        density, large = _density(w), [c for _, c in sides if c is not None]
        rows = sum(n for n, _ in sides)
        if len(large) == 2:
            for c in large:
                self.birth[c] = density
            return self.form(density, rows, tuple(large)), [False, False]
        if large:
            (now,) = large
            added = next(n for n, c in sides if c is None)
            self.weight[now] += added
            self.summed[now] += added * density
            return now, [c is None for _, c in sides]
        if rows >= self.least:
            return self.form(density, rows), [True, True]
        return None, [False, False]

    def chosen(self) -> dict[int, int]:
        """{cluster: the chosen one it lies in}; the cluster of all rows is never chosen."""
        parent = {c: i for i, kids in enumerate(self.children) for c in kids}
        value, picked = [], []
        for i, kids in enumerate(self.children):  # children come before their parents
            own = self.summed[i] - self.birth[i] * self.weight[i]
            below = sum(value[c] for c in kids)
            picked.append(i in parent and not below > own)
            value.append(max(own, below))
        out: dict[int, int] = {}
        for i in reversed(range(len(picked))):
            if parent.get(i) in out:
                out[i] = out[parent[i]]
            elif picked[i]:
                out[i] = i
        return out


def condense(forest: Forest, min_cluster_size: int, at_once: int = EDGES_AT_ONCE) -> tuple[DataFrame, CondensedTree]:
    """((pid, node, density): the cluster each point leaves last, and where; the clusters).

    A point leaves the first cluster its component joins or forms; later clusters hold it whole.
    """
    spark, tree = forest.points.sparkSession, CondensedTree(min_cluster_size)
    heavy = forest.points.where(F.col("weight") >= min_cluster_size).select("pid", "weight", "core")
    open_: dict[int, int] = {}  # clusters that still grow, by the component's root
    exits = []
    for r in heavy.orderBy("pid").collect():  # rows / min_cluster_size at most
        open_[r["pid"]] = tree.form(_density(r["core"]), r["weight"])
        exits.append((r["pid"], open_[r["pid"]], _density(r["core"])))
    kind = "root long, new_root long, new_node int, new_density double"

    def settled(label: DataFrame, rows: list[tuple]) -> DataFrame:
        update = spark.createDataFrame(rows, kind)
        moved = label.join(update, "root", "left")
        return checkpointed(
            moved.select(
                "pid", F.coalesce("new_root", "root").alias("root"), "weight",
                F.coalesce("node", "new_node").alias("node"), F.coalesce("density", "new_density").alias("density"),
            )
        )

    label = forest.points.select(
        "pid", F.col("pid").alias("root"), "weight", F.lit(None).cast("int").alias("node"), F.lit(None).cast("double").alias("density")
    )
    label = settled(label, [(p, p, node, density) for p, node, density in exits])
    ordered = checkpointed(dense_index(forest.edges, ["w", "lo", "hi"], "nth"))
    for start in range(0, ordered.count(), at_once):
        now = ordered.where(F.col("nth").between(start, start + at_once - 1))
        ends = now.select(F.explode(F.array("lo", "hi")).alias("pid")).distinct()
        roots = label.join(ends, "pid").select("pid", "root")
        root_of = {r["pid"]: r["root"] for r in roots.collect()}  # two an edge at most
        sizes = label.join(roots.select("root").distinct(), "root").groupBy("root").agg(F.sum("weight").alias("n"))
        rows = {r["root"]: r["n"] for r in sizes.collect()}
        loose = {r: [r] for r in rows if r not in open_}  # roots whose points are in no cluster yet
        moved: dict[int, int] = {}
        left: dict[int, tuple[int, float]] = {}

        def find(x: int, moved: dict[int, int] = moved) -> int:
            while x in moved:
                moved[x] = moved.get(moved[x], moved[x])
                x = moved[x]
            return x

        for e in now.orderBy("nth").collect():
            a, b = sorted((find(root_of[e["lo"]]), find(root_of[e["hi"]])))
            cluster, leaves = tree.join([(rows[r], open_.pop(r, None)) for r in (a, b)], e["w"])
            for r, gone in zip((a, b), leaves):
                if gone:
                    for own in loose.pop(r):
                        left[own] = (cluster, _density(e["w"]))
            if cluster is not None:
                open_[a] = cluster
            else:
                loose[a] += loose.pop(b)
            rows[a] += rows.pop(b)
            moved[b] = a
        label = settled(label, [(r, find(r), *left.get(r, (None, None))) for r in set(root_of.values())])
    return label.select("pid", "node", "density"), tree


def hierarchical_clusters(
    df: DataFrame,
    keys: list[str],
    vector: str = "vector",
    min_cluster_size: int = 30,
    min_samples: int | None = None,
    block_rows: int = BLOCK_ROWS,
    edges_at_once: int = EDGES_AT_ONCE,
) -> DataFrame:
    """Add cluster (-1 = noise) and cluster_prob to the key columns; no radius is asked for.

    min_samples defaults to min_cluster_size. cluster_prob is the density at which a row leaves
    its cluster, over the density at which the cluster itself ends, 1 at most; 0 for noise. Numbers
    follow vector order. Ties between edges go to the points that come first in vector order. A row
    without a vector is noise.
    """
    rows = df.select(*keys, F.col(vector).cast("array<double>").alias("__vec"))
    forest = spanning_forest(rows, "__vec", min_samples or min_cluster_size, block_rows)
    if not forest.total:
        return rows.select(*keys, F.lit(NOISE).cast("bigint").alias("cluster"), F.lit(0.0).alias("cluster_prob"))
    left, tree = condense(forest, min_cluster_size, edges_at_once)
    spark = df.sparkSession
    table = [(node, cluster, tree.death[cluster]) for node, cluster in tree.chosen().items()]
    chosen = spark.createDataFrame(table, "node int, chosen int, death double")
    infinite = F.lit(float("inf"))
    share = F.when((F.col("density") == infinite) | (F.col("death") == 0), 1.0).when(F.col("death") == infinite, 0.0)
    members = left.join(chosen, "node").select(
        "pid", "chosen", share.otherwise(F.least("density", "death") / F.col("death")).alias("prob")
    )
    first = members.groupBy("chosen").agg(F.min("pid").alias("first"))
    numbered = dense_index(first, ["first"], "cluster").select("chosen", "cluster")
    by_point = forest.points.join(members.join(numbered, "chosen"), "pid", "left").select("vec", "cluster", "prob")
    return rows.join(by_point, F.col("__vec") == F.col("vec"), "left").select(
        *keys,
        F.coalesce("cluster", F.lit(NOISE).cast("bigint")).alias("cluster"),
        F.coalesce("prob", F.lit(0.0)).alias("cluster_prob"),
    )
