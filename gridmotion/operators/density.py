"""Flat density clustering of vectors (the DBSCAN rule) for tables of any size.

Differs by design from a hierarchical density clustering: one radius holds everywhere.

Exact copies collapse into one weighted point first. Candidates come from distance bands
around a few pivots: by the triangle inequality, points within the radius lie in equal or
adjacent bands of every pivot. Points of a band are split by their nearest landmark into
blocks of bounded size. Every block knows its range of distances to each landmark, and a
block pair is dropped, before any vector moves, when two ranges lie farther apart than the
radius. A pair that is left yields neighbour counts and a spanning forest, at most one row per point, never the
pairs. Components are then joined on the forest edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmotion.operators.neighbors import distance_to
from gridmotion.operators.pivots import GROUP_BLOCKS, dealt, matrix, read_blocks
from gridmotion.operators.skew import dense_index
from gridmotion.session import checkpointed, scratch_path

BLOCK_ROWS = 512
N_PIVOTS = 2
N_LANDMARKS = 16
HELD_ROWS = 1_000_000  # found rows a task gathers before it reduces them
EXACT_VALUES = 2_000_000  # differences held at a time
NOISE = -1


def _exact(left: np.ndarray, right: np.ndarray, l_at: np.ndarray, r_at: np.ndarray) -> np.ndarray:
    """Squared distances of pairs, from differences."""
    out, step = np.empty(len(l_at)), max(1, EXACT_VALUES // max(1, right.shape[1]))
    for at in range(0, len(l_at), step):
        diff = left[l_at[at : at + step]] - right[r_at[at : at + step]]
        out[at : at + step] = np.einsum("nd,nd->n", diff, diff)
    return out


def _near(left: np.ndarray, right: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(left position, right position, rough squared distance) of all pairs within eps, and the roughness.

    Rough distances come from a matrix product; where they do not decide, differences do.
    """
    norms, r_norms = (np.einsum("nd,nd->n", side, side) for side in (left, right))
    room = 8 * (right.shape[1] + 5) * np.finfo(float).eps * sum(n[np.isfinite(n)].max(initial=0.0) for n in (norms, r_norms))
    asked = np.column_stack([left, norms, np.ones(len(left))])
    rough = asked @ np.column_stack([-2.0 * right, np.ones(len(right)), r_norms]).T
    l_at, r_at = np.nonzero(rough <= eps * eps + room)
    told = rough[l_at, r_at]
    open_ = np.flatnonzero(told >= eps * eps - room)
    if len(open_):
        hit = np.ones(len(told), bool)
        hit[open_] = _exact(left, right, l_at[open_], r_at[open_]) <= eps * eps
        l_at, r_at, told = l_at[hit], r_at[hit], told[hit]
    return l_at, r_at, told, room


def _count_kernel(eps: float):
    """Weighted neighbours each point of a block finds in the other block."""

    def run(pair: SimpleNamespace) -> Iterator[pd.DataFrame]:
        l_at, r_at, _, _ = _near(pair.l_vecs, pair.r_vecs, eps)
        parts = [(pair.l_pid, l_at, pair.r_flag[r_at])]
        if not pair.same:
            parts.append((pair.r_pid, r_at, pair.l_flag[l_at]))
        for ids, at, weights in parts:
            counts = np.bincount(at, weights, len(ids)).astype(np.int64)
            hit = counts > 0
            if hit.any():
                yield pd.DataFrame({"pid": ids[hit], "n": counts[hit]})

    return run


def _summed(found: pd.DataFrame) -> pd.DataFrame:
    return found.groupby("pid", as_index=False)["n"].sum()


def _stars(l_at: np.ndarray, r_at: np.ndarray, l_ids: np.ndarray, r_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smallest id of its component) that join what the pairs join."""
    ids, other = np.concatenate([l_ids, r_ids]), r_at + len(l_ids)
    root = ids.copy()
    while True:
        lowest, before = np.minimum(root[l_at], root[other]), root.copy()
        np.minimum.at(root, l_at, lowest)
        np.minimum.at(root, other, lowest)
        if np.array_equal(root, before):
            return ids[root != ids], root[root != ids]


def _link_kernel(eps: float):
    """Edges that join the core points within reach, and for other points their nearest core point."""

    def attach(ids, vecs, at, other_ids, other_vecs, other_at, rough, room):
        least = np.full(len(ids), np.inf)
        np.minimum.at(least, at, rough)
        close = rough <= least[at] + 2 * room
        at, other_at = at[close], other_at[close]
        squared = _exact(vecs, other_vecs, at, other_at)
        order = np.lexsort((other_at, squared, at))
        first = order[np.flatnonzero(np.diff(at[order], prepend=-1))]
        return pd.DataFrame({"kind": "border", "a": ids[at[first]], "b": other_ids[other_at[first]], "distance": np.sqrt(squared[first])})

    def run(pair: SimpleNamespace) -> Iterator[pd.DataFrame]:
        l_ids, r_ids, l_core, r_core = pair.l_pid, pair.r_pid, pair.l_flag, pair.r_flag
        l_at, r_at, rough, room = _near(pair.l_vecs, pair.r_vecs, eps)
        both = l_core[l_at] & r_core[r_at]
        if both.any():
            l_both, r_both = l_at[both], r_at[both]
            few = len(l_both) <= len(l_ids) + len(r_ids)
            a, b = (l_ids[l_both], r_ids[r_both]) if few else _stars(l_both, r_both, l_ids, r_ids)
            yield pd.DataFrame({"kind": "edge", "a": a, "b": b, "distance": 0.0})
        lone = ~l_core[l_at] & r_core[r_at]
        if lone.any():
            yield attach(l_ids, pair.l_vecs, l_at[lone], r_ids, pair.r_vecs, r_at[lone], rough[lone], room)
        lone = l_core[l_at] & ~r_core[r_at]
        if not pair.same and lone.any():
            yield attach(r_ids, pair.r_vecs, r_at[lone], l_ids, pair.l_vecs, l_at[lone], rough[lone], room)

    return run


def _spanned(found: pd.DataFrame) -> pd.DataFrame:
    """The same components by at most one edge a point, and each other point's nearest core point."""
    is_edge = found["kind"] == "edge"
    edges, border = found[is_edge], found[~is_edge]
    ids, ends = np.unique(edges[["a", "b"]].to_numpy(np.int64).ravel(), return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    root = np.arange(len(ids))
    while True:
        lowest = np.minimum(root[a], root[b])
        moved = root.copy()
        for side in (a, b, root[a], root[b]):
            np.minimum.at(moved, side, lowest)
        moved = moved[moved]
        if np.array_equal(moved, root):
            break
        root = moved
    hung = root != np.arange(len(ids))
    tree = pd.DataFrame({"kind": "edge", "a": ids[hung], "b": ids[root[hung]], "distance": 0.0})
    return pd.concat([tree, border.sort_values(["a", "distance", "b"]).drop_duplicates("a")], ignore_index=True)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an undirected edge list a-b; root is the smallest node.

    Alternates hanging larger and smaller neighbours under the smallest one until nothing
    moves. Each round is one minimum per node and one join, so a hub's neighbours are never
    gathered.
    """

    def oriented(pairs: DataFrame) -> DataFrame:
        return (
            pairs.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )

    def fingerprint(pairs: DataFrame):
        return tuple(
            pairs.agg(
                F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
            ).first()
        )

    current = checkpointed(oriented(edges))
    state = fingerprint(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        hung = oriented(
            both.where(F.col("b") > F.col("a"))
            .join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        lowest = hung.groupBy("a").agg(F.min("b").alias("m"))
        hung = oriented(
            hung.join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b")))
        )
        current = checkpointed(hung)
        previous, state = state, fingerprint(current)
        if state == previous:
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _landmark_distances(vector: str, landmarks: list[list[float]]) -> Column:
    """Distances of an array column to fixed points, as an array."""

    def squared(point: list[float]) -> Column:
        gaps = F.zip_with(
            F.col(vector),
            F.array(*[F.lit(float(v)) for v in point]),
            lambda a, b: (a.cast("double") - b) * (a.cast("double") - b),
        )
        return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)

    return F.array(*[F.sqrt(squared(point)) for point in landmarks])


def _block_ranges(placed: DataFrame, key: list[str], n: int) -> DataFrame:
    """Per block the least and largest distance to each landmark: one small row a block."""
    sides = {"lo": F.min, "hi": F.max}
    wide = placed.groupBy(*key).agg(
        *[f(F.col("landmarks")[i]).alias(f"{s}{i}") for s, f in sides.items() for i in range(n)]
    )
    return wide.select(*key, *[F.array(*[f"{s}{i}" for i in range(n)]).alias(s) for s in sides])


def _within_reach(pairs: DataFrame, ranges: DataFrame, key: list[str], eps: float) -> DataFrame:
    """Block pairs whose ranges overlap, up to the radius, at every landmark."""
    out = pairs
    for side in ("l", "r"):
        named = ranges.select(
            *[F.col(c).alias(f"{side}_{c}") for c in key],
            *[F.col(c).alias(f"__{side}_{c}") for c in ("lo", "hi")],
        )
        out = out.join(named, [f"{side}_{c}" for c in key])
    gaps = F.zip_with("__l_lo", "__r_hi", lambda a, b: a - b), F.zip_with(
        "__r_lo", "__l_hi", lambda a, b: a - b
    )
    apart = F.greatest(*[F.array_max(gap) for gap in gaps]) > eps * (1 + 1e-9) + 1e-12
    return out.where(~apart).select(*pairs.columns)


def _block_pairs(placed: DataFrame, cells: DataFrame, bands: list[str]) -> DataFrame:
    """Keys of all block pairs in equal or adjacent cells, each pair once; no vectors yet."""
    key = [*bands, "near", "block"]
    shifts = F.array(
        *[
            F.struct(*[(F.col(f"l_{b}") + F.lit(s)).alias(b) for b, s in zip(bands, shift)])
            for shift in product((-1, 0, 1), repeat=len(bands))
        ]
    )
    left = placed.select(*[F.col(c).alias(f"l_{c}") for c in key]).distinct()
    left = left.select("*", F.inline(shifts)).join(cells, bands)
    pairs = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    mine = F.struct(*[F.col(f"l_{c}") for c in key])
    other = F.struct(*[F.col(c).alias(f"l_{c}") for c in key])
    return pairs.where(mine <= other).select(
        *[f"l_{c}" for c in key],
        *[F.col(c).alias(f"r_{c}") for c in key],
        (mine == other).alias("same"),
    )


def _meet(pairs: DataFrame, table: DataFrame, bands: list[str], vector: str, flag: str, kernel, reduce, schema: str) -> DataFrame:
    """The kernel's rows on all pairs of blocks, reduced within a task's group of left blocks.

    Blocks (members in pid order) are stored once; a group reads the right blocks it meets from the
    stored files, so only numbers of blocks and each left block, once, are shuffled.
    """
    spark, key = table.sparkSession, [*bands, "near", "block"]
    members = F.sort_array(F.collect_list(F.struct("pid", F.col(flag).alias("flag"), F.col(vector).cast("array<double>").alias("v"))))
    packed = table.groupBy(*key).agg(members.alias("m")).select(
        *[F.col(c).alias(f"key_{c}") for c in key],
        F.monotonically_increasing_id().alias("block"),
        F.transform("m", lambda e: F.struct(e["pid"].alias("pid"), e["flag"].alias("flag"))).alias("ids"),
        F.col("m.v").alias("vecs"),
    )
    path = scratch_path(spark, "density-blocks")
    packed.write.parquet(path)
    blocks = spark.read.schema(packed.schema).parquet(path)
    numbered = pairs
    for side in ("l", "r"):
        numbers = blocks.select(*[F.col(f"key_{c}").alias(f"{side}_{c}") for c in key], F.col("block").alias(f"__{side}"))
        numbered = numbered.join(numbers, [f"{side}_{c}" for c in key])
    asked = numbered.groupBy(F.col("__l").alias("block")).agg(F.collect_list(F.struct(F.col("__r").alias("r"), "same")).alias("met"))
    left = dealt(asked.join(blocks.select("block", "ids", "vecs"), "block"), "block", blocks.count(), GROUP_BLOCKS)

    def side_of(side: str, ids: pa.StructArray, vecs: pa.Array) -> dict:
        fields = {c: ids.field(c).to_numpy(zero_copy_only=False) for c in ("pid", "flag")}
        return {f"{side}_pid": fields["pid"], f"{side}_flag": fields["flag"], f"{side}_vecs": matrix(vecs)}

    names = [part.split()[0] for part in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    arrow = pa.schema([(part.split()[0], types[part.split()[1]]) for part in schema.split(", ")])

    def search(group: pa.Table) -> pa.Table:
        lefts, asking = [], {}
        for i in range(group.num_rows):
            lefts.append(side_of("l", group.column("ids")[i].values, group.column("vecs")[i].values))
            for e in group.column("met")[i].as_py():
                asking.setdefault(e["r"], []).append((i, e["same"]))
        found, held = [], 0
        for block, ids, vecs in read_blocks(path, asking):
            right = side_of("r", ids, vecs)
            for i, same in asking[block]:
                fresh = list(kernel(SimpleNamespace(same=same, **lefts[i], **right)))
                found += fresh
                held += sum(map(len, fresh))
            if held > HELD_ROWS and len(found) > 1:
                found = [reduce(pd.concat(found, ignore_index=True))]
                held = 0
        rows = reduce(pd.concat(found, ignore_index=True)) if found else pd.DataFrame(columns=names)
        return pa.Table.from_pandas(rows[names], arrow, preserve_index=False)

    return left.groupBy("group").applyInArrow(search, schema)


def density_clusters(
    df: DataFrame,
    keys: list[str],
    vector: str = "vector",
    eps: float = 5.0,
    min_samples: int = 5,
    min_cluster_size: int = 5,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add cluster (-1 = noise) and cluster_prob to the key columns.

    A row is core when at least min_samples rows, itself included, lie within eps. Core rows
    within eps share a cluster; another row joins its nearest core row within eps. Clusters
    below min_cluster_size rows are noise. cluster_prob is 1 for core rows, falls linearly
    to 0 at distance eps for joined rows, and is 0 for noise. Numbers follow vector order.
    """
    rows = df.select(*keys, vector)
    distinct = rows.groupBy(vector).agg(F.count(F.lit(1)).alias("weight"))
    points = dense_index(distinct, [vector], "pid")
    total = points.count()
    if total == 0:
        return rows.select(
            *keys, F.lit(NOISE).cast("bigint").alias("cluster"), F.lit(0.0).alias("cluster_prob")
        )

    def spread(n: int) -> list[list[float]]:
        """n points, even in vector order."""
        at = sorted({round(i * (total - 1) / max(n - 1, 1)) for i in range(n)})
        return [list(r[vector]) for r in points.where(F.col("pid").isin(at)).collect()]

    pivots, landmarks = spread(N_PIVOTS), spread(N_LANDMARKS)

    width = eps * (1 + 1e-9)
    bands = [f"band_{i}" for i in range(len(pivots))]
    points = points.withColumns(
        {
            band: F.floor(distance_to(vector, pivot) / width)
            for band, pivot in zip(bands, pivots)
        }
    )
    points = points.withColumn("landmarks", _landmark_distances(vector, landmarks))
    nearest_one = F.array_position("landmarks", F.array_min("landmarks")).cast("int")
    points = points.withColumn("near", nearest_one)
    cells = points.groupBy(*bands, "near").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("n_blocks")
    )
    placed = checkpointed(
        points.join(cells, [*bands, "near"]).withColumn(
            "block", F.pmod(F.xxhash64("pid"), F.col("n_blocks")).cast("int")
        )
    )

    key = [*bands, "near", "block"]
    ranges = _block_ranges(placed, key, len(landmarks))
    pairs = checkpointed(_within_reach(_block_pairs(placed, cells, bands), ranges, key, eps))
    counts = (
        _meet(pairs, placed, bands, vector, "weight", _count_kernel(eps), _summed, "pid long, n long")
        .groupBy("pid")
        .agg((F.sum("n") >= min_samples).alias("is_core"))
    )
    judged = checkpointed(placed.join(counts, "pid"))
    link = "kind string, a long, b long, distance double"
    links = checkpointed(_meet(pairs, judged, bands, vector, "is_core", _link_kernel(eps), _spanned, link))
    roots = connected_components(links.where("kind = 'edge'").select("a", "b"))

    core = judged.where("is_core").select("pid", "weight")
    core = core.join(roots, core.pid == roots.node, "left").select(
        "pid", "weight", F.coalesce("root", "pid").alias("root"), F.lit(1.0).alias("prob")
    )
    nearest = (
        links.where("kind = 'border'")
        .groupBy(F.col("a").alias("pid"))
        .agg(F.min(F.struct("distance", F.col("b").alias("core_pid"))).alias("m"))
        .select("pid", "m.distance", "m.core_pid")
    )
    border = (
        nearest.join(core.select(F.col("pid").alias("core_pid"), "root"), "core_pid")
        .join(judged.select("pid", "weight"), "pid")
        .select("pid", "weight", "root", (1.0 - F.col("distance") / F.lit(eps)).alias("prob"))
    )
    members = core.union(border)
    kept = (
        members.groupBy("root")
        .agg(F.sum("weight").alias("size"))
        .where(F.col("size") >= min_cluster_size)
    )
    numbered = dense_index(kept.select("root"), ["root"], "cluster")
    labelled = members.join(numbered, "root").select("pid", "cluster", "prob")
    by_vector = (
        points.select("pid", vector)
        .join(labelled, "pid", "left")
        .select(
            vector,
            F.coalesce("cluster", F.lit(NOISE).cast("bigint")).alias("cluster"),
            F.coalesce("prob", F.lit(0.0)).alias("cluster_prob"),
        )
    )
    return rows.join(by_vector, vector).select(*keys, "cluster", "cluster_prob")
