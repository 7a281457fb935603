"""Growing boosted regression trees for several targets side by side, level by level, over binned rows.

Rows are cut into 32 bins a feature at quantiles of all rows and written once, as blocks of bytes, to
the shared folder. Each level of a tree is one pass of the tasks over their own blocks, for all
targets at once: a row goes one node down, and nodes are summed by feature and bin, of two sisters
only the one with fewer rows (the other is what the parent has besides). A task keeps what its rows
still lack and the nodes they are in as files beside the blocks. The driver receives these sums and
splits the nodes. Row and column shares, tree weights, squared loss, pseudo-residuals and early
stopping are those of Spark's GBTRegressor, and the result is its model.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkContext, TaskContext
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmotion.session import _remove_quietly, scratch_path

BINS = 32
PROBES = 4  # quantiles looked at for each bin, so that a feature of few values is cut between all of them
RANK_ERROR = 0.001
BLOCK_ROWS = 131_072
CHUNK_ROWS = 16_384  # summed at a time, so that the sums stay in a core's cache
TASK_ROWS = 20_000  # fewer are not worth a task of their own
ALONE_ROWS = 500_000  # up to so many a task for each target grows its trees alone: passes of many tasks would mostly wait
GROUP_ROWS = 4_000_000  # rows of a task at most; it holds one block at a time
OUT = 1 << 15  # marks the node of a row that the tree does not grow on
DEEPEST = 13  # nodes are numbered below OUT


@dataclass
class Tree:
    """Nodes by number: those below node i are 2 i + 1 and 2 i + 2."""

    feature: np.ndarray  # -1 at a leaf
    cut: np.ndarray  # the last bin that goes left
    gain: np.ndarray
    stats: np.ndarray  # rows, sum and sum of squares of the target

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros((n, 3)))

    @property
    def values(self) -> np.ndarray:
        return self.stats[:, 1] / np.maximum(self.stats[:, 0], 1)


def cut_points(rows: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature, fewer than bins: all its probed values, or even quantiles if there are more."""
    probes = bins * PROBES
    found = rows.approxQuantile(features, [i / probes for i in range(1, probes)], RANK_ERROR)
    out = []
    for values in found:
        distinct = np.unique(np.array(values, float))
        out.append(distinct if len(distinct) < bins else np.unique(np.array(values, float)[PROBES - 1 :: PROBES]))
    return out


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    uri = "/" + uri[len("file:") :].lstrip("/") if uri.startswith("file:") else uri
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _write_blocks(rows: DataFrame, features: list[str], targets: list[str], held: str | None, cuts: list[np.ndarray], folder: str) -> list[tuple[str, int]]:
    """(file, rows) of the blocks: bins by feature, targets, and whether a row is held out."""
    columns = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate([*features, *targets])]
    columns.append((F.coalesce(F.col(held), F.lit(False)) if held else F.lit(False)).alias("held"))
    n_features = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        part, count = TaskContext.get().partitionId(), 0

        def block(waiting: list[list[np.ndarray]], n: int) -> pa.RecordBatch:
            whole = [np.concatenate(parts) for parts in zip(*waiting)]
            bins = [np.searchsorted(cut, column, "left").astype(np.uint8) for cut, column in zip(cuts, whole)]
            name = f"{base}/block-{part:06d}-{count:06d}-{uuid.uuid4().hex}"
            with store.open_output_stream(name) as out:
                for column in (*bins, *(c.astype("<f8") for c in whole[n_features:-1]), whole[-1].astype(np.uint8)):
                    out.write(column.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], ["name", "n"])

        waiting, n = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, BLOCK_ROWS - n)
                batch = batch.slice(taken.num_rows)
                waiting.append([c.to_numpy(zero_copy_only=False) for c in taken.columns])
                n += taken.num_rows
                if n == BLOCK_ROWS:
                    yield block(waiting, n)
                    waiting, n, count = [], 0, count + 1
        if n:
            yield block(waiting, n)

    return sorted((r["name"], r["n"]) for r in rows.select(*columns).mapInArrow(run, "name string, n long").collect())  # a listing


def _add(sums: dict, bins: np.ndarray, node: np.ndarray, target: np.ndarray, slot: np.ndarray) -> None:
    """Sum a block's rows by slot, feature and bin; rows whose node has no slot are left out."""
    wide = sums["squares"].size * BINS
    for at in range(0, len(node), CHUNK_ROWS):
        own = slot[node[at : at + CHUNK_ROWS]]
        hit = np.flatnonzero(own >= 0)
        if not len(hit):
            continue
        own, t = own[hit], target[at : at + CHUNK_ROWS][hit]
        base, part = own * BINS, bins[:, at : at + CHUNK_ROWS]
        whole = len(hit) == part.shape[1]
        for f in range(len(bins)):
            key = base + (part[f] if whole else part[f][hit])
            sums["rows"][f] += np.bincount(key, minlength=wide)
            sums["sums"][f] += np.bincount(key, t, wide)
        sums["squares"] += np.bincount(own, t * t, len(sums["squares"]))


def _slots(nodes: list[int]) -> np.ndarray:
    """The slot of each node's sums by its number, -1 for others."""
    out = np.full(2 * OUT, -1, np.int64)
    out[nodes] = np.arange(len(nodes))
    return out


def _down(bins: np.ndarray, node: np.ndarray, tree: Tree) -> np.ndarray:
    """Every row's node one level down; rows in a leaf stay."""
    at = node & (OUT - 1)
    feature = tree.feature[at]
    right = bins[np.maximum(feature, 0), np.arange(len(node))] > tree.cut[at]
    return np.where(feature < 0, node, (2 * at + 1 + right) | (node & OUT)).astype("<u2")


class _Growth:
    """One fit: blocks dealt to tasks, and the files that hold the state of their rows."""

    def __init__(self, context: SparkContext | None, blocks: list[tuple[str, int]], n_features: int, n_targets: int, folder: str, share: float, seed: int):
        self.folder, self.share, self.seed = folder, share, seed
        self.n_features, self.n_targets = n_features, n_targets
        total = sum(n for _, n in blocks)
        wanted = max(min(context.defaultParallelism, -(-total // TASK_ROWS)), -(-total // GROUP_ROWS)) if context else 1
        groups: list[list[tuple[int, str, int]]] = [[] for _ in range(max(1, min(wanted, len(blocks))))]
        load = [0] * len(groups)
        for number, (name, n) in sorted(enumerate(blocks), key=lambda b: (-b[1][1], b[0])):
            least = load.index(min(load))
            groups[least].append((number, name, n))
            load[least] += n
        self.groups = list(enumerate(groups))
        self.dealt = context.parallelize(self.groups, len(groups)) if context else None  # without Spark this is one task
        self.state: dict[int, dict[str, str]] = {i: {} for i in range(len(groups))}

    def start(self, round_: int, roots: list[list[int]], old: list[Tree | None], weight: float, old_scale: float, scale: float) -> list[dict]:
        """Rows go on to their leaves in the old trees, lack less from then on, and are summed at the new roots.

        roots are by target, none where no further tree grows; old trees likewise. Targets are
        `scale` times what a row lacks, for the old trees `old_scale` times.
        """
        share, seed, n_features, n_targets = self.share, self.seed, self.n_features, self.n_targets

        def block(place: int, n: int, bins: np.ndarray, lack: np.ndarray, nodes: np.ndarray | None, held: np.ndarray, slots: list[np.ndarray], sums: list[dict]):
            lack = lack.copy()
            out = held if share >= 1 else held | (np.random.default_rng([seed, round_, place]).random(n) >= share)
            for i, tree in enumerate(old):
                if tree is None:
                    continue
                leaf = _down(bins, nodes[i], tree)
                grown_on, leaf = leaf < OUT, leaf & (OUT - 1)
                sums[i]["leaves"] += np.bincount(leaf[grown_on], (old_scale * lack[i][grown_on]) ** 2, len(tree.feature))
                lack[i] -= weight * tree.values[leaf]
                sums[i]["error"] += float((lack[i][held] ** 2).sum())
                sums[i]["held"] += int(held.sum())
            fresh = np.where(out, OUT, 0).astype("<u2")
            for i, root in enumerate(roots):
                if root:
                    _add(sums[i], bins, fresh, scale * lack[i], slots[i])
            return np.stack([fresh] * n_targets), lack

        def extra(i: int) -> dict:
            return {"leaves": np.zeros(0 if old[i] is None else len(old[i].feature)), "error": 0.0, "held": 0}

        return self._pass(roots, block, extra, n_features, True)

    def level(self, wanted: list[list[int]], trees: list[Tree | None], scale: float) -> list[dict]:
        """Rows go one level down the trees and are summed at the wanted nodes; none where a tree has no further level."""

        def block(place: int, n: int, bins: np.ndarray, lack: np.ndarray, nodes: np.ndarray, held: None, slots: list[np.ndarray], sums: list[dict]):
            after = [_down(bins, node, tree) if own else node for node, tree, own in zip(nodes, trees, wanted)]
            for i, own in enumerate(wanted):
                if own:
                    _add(sums[i], bins, after[i], scale * lack[i], slots[i])
            return np.stack(after), None

        return self._pass(wanted, block, lambda i: {}, self.n_features, False)

    def _pass(self, wanted: list[list[int]], block, extra, n_features: int, starts: bool) -> list[dict]:
        state, folder, n_targets = self.state, self.folder, self.n_targets

        def task(groups: Iterator) -> Iterator[tuple]:
            store, base = _store(folder)
            slots = [_slots(own) for own in wanted]
            for number, blocks in groups:
                sums = [
                    {"rows": np.zeros((n_features, n * BINS), np.int64), "sums": np.zeros((n_features, n * BINS)), "squares": np.zeros(n), **extra(i)}
                    for i, n in enumerate(map(len, wanted))
                ]
                names = {key: f"{base}/{key}-{number}-{uuid.uuid4().hex}" for key in (("node", "lack") if starts else ("node",))}
                old = {key: store.open_input_stream(name) for key, name in state[number].items()}
                new = {key: store.open_output_stream(name) for key, name in names.items()}
                for place, name, n in blocks:
                    nodes = held = None
                    with store.open_input_file(name) as opened:
                        bins = np.frombuffer(opened.read_at(n_features * n, 0), np.uint8).reshape(n_features, n)
                        if starts:
                            held = np.frombuffer(opened.read_at(n, (n_features + 8 * n_targets) * n), bool)
                        if "lack" not in old:  # at first a row lacks its targets
                            lack = np.frombuffer(opened.read_at(8 * n_targets * n, n_features * n), "<f8").reshape(n_targets, n)
                    if "lack" in old:
                        lack = np.frombuffer(old["lack"].read(8 * n_targets * n), "<f8").reshape(n_targets, n)
                        nodes = np.frombuffer(old["node"].read(2 * n_targets * n), "<u2").reshape(n_targets, n)
                    node, lack = block(place, n, bins, lack, nodes, held, slots, sums)
                    new["node"].write(node.tobytes())
                    if starts:
                        new["lack"].write(lack.tobytes())
                for stream in (*old.values(), *new.values()):
                    stream.close()
                yield number, names, sums

        # A few numbers a node, feature and bin from each task.
        found = list(task(iter(self.groups))) if self.dealt is None else self.dealt.mapPartitions(task).collect()
        store, _ = _store(folder)
        totals: list[dict] = [{} for _ in range(n_targets)]
        for number, names, sums in sorted(found, key=lambda f: f[0]):
            for key, name in names.items():
                if key in state[number]:
                    store.delete_file(state[number][key])
                state[number][key] = name
            totals = [own if not total else {key: total[key] + own[key] for key in own} for total, own in zip(totals, sums)]
        return totals


def _columns(strategy: str, n: int) -> int:
    """Features a node looks at."""
    if strategy in ("all", "auto"):
        return n
    if strategy.isdigit() and int(strategy) > 1:
        return min(n, int(strategy))
    return max(1, min(n, math.ceil(float(strategy) * n)))


class _Target:
    """The trees of one target, and the sums of the nodes that may be split next."""

    def __init__(self, settings: dict, n_features: int):
        self.depth, self.n_features = settings["depth"], n_features
        self.columns = _columns(settings["columns"], n_features)
        self.rng = np.random.default_rng(settings["seed"])
        self.trees: list[Tree] = []
        self.growing, self.done = False, False
        self.least, self.kept = math.inf, 0

    def wanted(self) -> list[int]:
        """The nodes to be summed: the root, or of two sisters the one with fewer rows."""
        return self.asked if self.growing else []

    def begin(self) -> None:
        self.trees.append(Tree.empty(self.depth))
        self.growing, self.asked, self.held = True, [0], {}

    def take(self, found: dict, level: int) -> None:
        """Take in the sums that were asked for and split the nodes of the level."""
        tree, shape = self.trees[-1], (self.n_features, len(self.asked), BINS)
        rows, sums = found["rows"].reshape(shape), found["sums"].reshape(shape)
        now = {}
        for slot, node in enumerate(self.asked):
            now[node] = (rows[:, slot], sums[:, slot])
            tree.stats[node] = (rows[0, slot].sum(), sums[0, slot].sum(), found["squares"][slot])
            if node:
                above, sister = (node - 1) // 2, node + 1 if node % 2 else node - 1
                now[sister] = tuple(whole - part for whole, part in zip(self.held[above], now[node]))
                tree.stats[sister] = tree.stats[above] - tree.stats[node]
        self.held, self.asked = {}, []
        for node in sorted(now):
            if level < self.depth and self._split(tree, node, *now[node]):
                self.held[node] = now[node]
                left, right = 2 * node + 1, 2 * node + 2
                self.asked.append(left if tree.stats[left, 0] <= tree.stats[right, 0] else right)
        self.growing = bool(self.asked) and level + 1 < self.depth  # leaves of the last level need no sums

    def _split(self, tree: Tree, node: int, rows: np.ndarray, sums: np.ndarray) -> bool:
        """Split a node where its variance falls most, if it does."""
        n, total, squares = tree.stats[node]
        left_n, left_s = rows.cumsum(axis=1)[:, :-1], sums.cumsum(axis=1)[:, :-1]
        right_n, right_s = n - left_n, total - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where((left_n > 0) & (right_n > 0), left_s**2 / left_n + right_s**2 / right_n, -np.inf)
        score[self.rng.permutation(self.n_features)[self.columns :]] = -np.inf
        feature, cut = np.unravel_index(int(score.argmax()), score.shape)
        if n < 2 or score[feature, cut] - total * total / n <= 1e-12 * squares:
            return False
        tree.feature[node], tree.cut[node], tree.gain[node] = feature, cut, (score[feature, cut] - total * total / n) / n
        tree.stats[2 * node + 1, :2] = left_n[feature, cut], left_s[feature, cut]
        tree.stats[2 * node + 2, :2] = right_n[feature, cut], right_s[feature, cut]
        return True

    def finish(self, found: dict, held: bool, tolerance: float) -> None:
        """Complete the last tree's leaves; with held-out rows, judge it by their error."""
        tree = self.trees[-1]
        leaf = tree.feature < 0
        tree.stats[leaf, 2] = found["leaves"][leaf]
        if not held:
            self.kept = len(self.trees)
            return
        error = found["error"] / max(1, found["held"])
        if len(self.trees) > 1 and self.least - error < tolerance * max(error, 0.01):
            self.done = True
        elif error < self.least:
            self.least, self.kept = error, len(self.trees)


def grow(
    rows: DataFrame, features: list[str], targets: list[str], settings: dict, held: str | None = None, tolerance: float = 0.01
) -> tuple[list[list[Tree]], list[np.ndarray]]:
    """(trees of each target, cuts of each feature).

    rows have finite features and no missing target. held names a boolean column: its true rows are
    not learnt from, and a target has trees only up to where its error on them no longer fell.
    """
    spark, depth, seed = rows.sparkSession, settings["depth"], settings["seed"]
    if not 0 <= depth <= DEEPEST:
        raise ValueError(f"a depth of 0 to {DEEPEST} levels is supported")
    cuts = cut_points(rows, features)
    folder = scratch_path(spark, "boosting")
    try:
        blocks = _write_blocks(rows, features, targets, held, cuts, folder)
        if not blocks:
            raise ValueError("no rows to fit trees on")
        asked = (blocks, len(features), len(targets), folder, settings["rows"], seed)
        told = (settings, held is not None, tolerance)
        if sum(n for _, n in blocks) > ALONE_ROWS:
            return _grown(_Growth(spark.sparkContext, *asked), *told), cuts
        each = spark.sparkContext.parallelize(range(len(targets)), len(targets))
        arrays = each.map(lambda i: [tuple(vars(tree).values()) for tree in _grown(_Growth(None, *asked), *told, only=i)[i]]).collect()
        return [[Tree(*tree) for tree in own] for own in arrays], cuts
    finally:
        _remove_quietly(folder)


def _grown(growth: _Growth, settings: dict, held: bool, tolerance: float, only: int | None = None) -> list[list[Tree]]:
    targets = [_Target(settings, growth.n_features) for _ in range(growth.n_targets)]
    for i, target in enumerate(targets):
        target.done = only not in (None, i)
    for round_ in range(settings["trees"] + 1):  # the last round only completes the last trees
        # The first tree is fitted to the targets, later ones to the gradient of the squared loss.
        old = [t.trees[-1] if t.trees and not t.done else None for t in targets]
        weight, old_scale, scale = (1.0, 1.0, 2.0) if round_ == 1 else (settings["step"], 2.0, 2.0 if round_ else 1.0)
        for target in targets:
            target.growing = False
            if round_ < settings["trees"] and not target.done:
                target.begin()
        found = growth.start(round_, [t.wanted() for t in targets], old, weight, old_scale, scale)
        for target, tree, sums in zip(targets, old, found):
            if tree is not None:
                fresh = target.trees.pop() if target.growing else None
                target.finish(sums, held, tolerance)
                if target.done:
                    target.growing = False
                elif fresh is not None:
                    target.trees.append(fresh)
            if target.growing:
                target.take(sums, 0)
        for level in range(1, settings["depth"]):
            if not any(t.growing for t in targets):
                break
            found = growth.level([t.wanted() for t in targets], [t.trees[-1] if t.trees else None for t in targets], scale)
            for target, sums in zip(targets, found):
                if target.growing:
                    target.take(sums, level)
        if all(t.done for t in targets):
            break
    return [t.trees[: t.kept] for t in targets]


def as_model(trees: list[Tree], cuts: list[np.ndarray], estimator: GBTRegressor) -> GBTRegressionModel:
    """The trees as the estimator's fitted model."""
    context = SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml
    kinds = (context._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit)
    variance, leaf, inner, continuous = kinds
    part_of = context._jvm.java.util.Arrays.copyOfRange

    def node(tree: Tree, values: np.ndarray, stats, i: int):
        n, total, squares = tree.stats[i]
        impurity = float(max(0.0, squares / max(n, 1) - values[i] ** 2))
        calculator = variance(part_of(stats, 3 * i, 3 * i + 3), int(n))
        if tree.feature[i] < 0:
            return leaf(float(values[i]), impurity, calculator)
        at = int(tree.feature[i])
        below = [node(tree, values, stats, j) for j in (2 * i + 1, 2 * i + 2)]
        return inner(float(values[i]), impurity, float(tree.gain[i]), *below, continuous(at, float(cuts[at][tree.cut[i]])), calculator)

    kind, gateway = ml.regression.DecisionTreeRegressionModel, context._gateway
    roots, weights = gateway.new_array(kind, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i, tree in enumerate(trees):
        stats = _py2java(context, DenseVector(tree.stats.ravel())).values()
        roots[i] = kind(f"{estimator.uid}_tree_{i}", node(tree, tree.values, stats, 0), len(cuts))
        weights[i] = estimator.getStepSize() if i else 1.0
    model = GBTRegressionModel(ml.regression.GBTRegressionModel(estimator.uid, roots, weights, len(cuts)))
    model._resetUid(estimator.uid)
    estimator._copyValues(model)
    model._transfer_params_to_java()
    return model
