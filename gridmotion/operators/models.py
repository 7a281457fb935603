"""Boosted-tree models of x and y, their search and scoring, and the kinematic baseline.

Trees grow level by level on Spark (see `boosting`), so fitted values differ from leaf-wise
libraries; the features, splits and error measures are the same.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from gridmotion.functions import scalars as S
from gridmotion.operators import boosting
from gridmotion.operators.evaluate import rmse
from gridmotion.operators.rollups import last_states
from gridmotion.operators.sampling import fold_column, sample_sequences, split_column
from gridmotion.schemas import ROW_KEYS, TICK_SECONDS, TIMELINE_KEYS

# The boosting settings of the lag model and of the t0 model.
LAG_SETTINGS = {"trees": 200, "step": 0.05, "depth": 6, "rows": 0.9, "columns": "0.9", "seed": 42}
T0_SETTINGS = {**LAG_SETTINGS, "trees": 300}
SIDE_BY_SIDE = 4  # fits that run at once


def together(spark: SparkSession, tasks: list[Callable]) -> list:
    """Results of independent driver steps whose Spark jobs may overlap."""
    if len(tasks) < 2:
        return [task() for task in tasks]
    with ThreadPoolExecutor(min(SIDE_BY_SIDE, len(tasks))) as pool:
        return list(pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks))


@dataclass
class AxisModels:
    """One fitted pipeline per axis."""

    x: PipelineModel
    y: PipelineModel
    features: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add pred_x and pred_y."""
        scored = self.x.transform(df).drop("__features_x")
        return self.y.transform(scored).drop("__features_y")

    def save(self, path: str) -> None:
        self.x.write().overwrite().save(f"{path}/x")
        self.y.write().overwrite().save(f"{path}/y")

    @classmethod
    def load(cls, path: str) -> AxisModels:
        x, y = PipelineModel.load(f"{path}/x"), PipelineModel.load(f"{path}/y")
        return cls(x, y, list(x.stages[0].getInputCols()))

    def n_trees(self) -> tuple[int, int]:
        return self.x.stages[-1].getNumTrees, self.y.stages[-1].getNumTrees


def _pipeline(features, target, axis, settings, validation) -> Pipeline:
    assembler = VectorAssembler(
        inputCols=features, outputCol=f"__features_{axis}", handleInvalid="keep"
    )
    options = {}
    if validation:
        options = {"validationIndicatorCol": validation, "validationTol": settings.get("tol", 0.01)}
    trees = GBTRegressor(
        featuresCol=f"__features_{axis}",
        labelCol=target,
        predictionCol=f"pred_{axis}",
        maxIter=settings["trees"],
        stepSize=settings["step"],
        maxDepth=settings["depth"],
        subsamplingRate=settings["rows"],
        featureSubsetStrategy=settings["columns"],
        seed=settings["seed"],
        cacheNodeIds=False,  # a row finds its node in at most `depth` steps; a cache costs a pass and files a level
        maxMemoryInMB=1024,  # the nodes of a level are found in one job
        **options,
    )
    return Pipeline(stages=[assembler, trees])


def fit_axes(
    df: DataFrame,
    features: list[str],
    targets: tuple[str, str] = ("x", "y"),
    settings: dict | None = None,
    validation: str | None = None,
) -> AxisModels:
    """Fit one boosted-tree model per axis.

    validation names a boolean column; boosting stops when the error on its true rows no
    longer falls.
    """
    settings = {**LAG_SETTINGS, **(settings or {})}
    # The assembled features must be finite; missing values become 0 as in the sequences.
    train = df.select(*features, *targets, *([validation] if validation else [])).dropna(
        subset=list(targets)
    )
    train = train.withColumns({c: S.zero_if_not_finite(F.col(c)) for c in features})
    train = train.persist()  # rebuilt from lineage when an executor is lost
    try:
        n = train.count()
        cores = df.sparkSession.sparkContext.defaultParallelism
        even = train.coalesce(max(1, -(-n // boosting.BLOCK_ROWS), min(cores, -(-n // boosting.TASK_ROWS))))
        trees, cuts = boosting.grow(even, features, list(targets), settings, validation, settings.get("tol", 0.01))
    finally:
        train.unpersist()
    x, y = (
        _fitted(_pipeline(features, target, axis, settings, validation), grown, cuts)
        for axis, target, grown in zip(("x", "y"), targets, trees)
    )
    return AxisModels(x, y, list(features))


def _fitted(pipeline: Pipeline, trees: list[boosting.Tree], cuts: list) -> PipelineModel:
    assembler, estimator = pipeline.getStages()
    return PipelineModel([assembler, boosting.as_model(trees, cuts, estimator)])


def score(models: AxisModels, df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """pred_x, pred_y beside the kept columns."""
    kept = df.select(
        *[F.col(c).alias(f"__keep_{c}") for c in keep],
        *[S.zero_if_not_finite(F.col(c)).alias(c) for c in features],
    )
    out = models.transform(kept)
    return out.select(*[F.col(f"__keep_{c}").alias(c) for c in keep], "pred_x", "pred_y")


def score_with_python(
    df: DataFrame, columns: list[str], predict: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Score with any Python model, one Arrow batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield predict(batch)

    return df.select(*columns).mapInPandas(run, schema)


def holdout_error(
    df: DataFrame,
    features: list[str],
    targets: tuple[str, str] = ("x", "y"),
    settings: dict | None = None,
    test: float = 0.2,
    split_keys: list[str] | None = None,
    seed: int = 42,
    mode: str = "mean_sq2d",
) -> tuple[AxisModels, DataFrame, DataFrame]:
    """Fit on the training part; return models, scored test rows and their error table."""
    keys = split_keys or ["game_id", "play_id"]
    parts = split_column(df, {"train": 1.0 - test, "test": test}, keys=keys, seed=seed)
    models = fit_axes(parts.where("split = 'train'"), features, targets, settings)
    held = parts.where("split = 'test'")
    keep = list(dict.fromkeys([*ROW_KEYS, *targets]))
    scored = score(models, held, features, keep)
    return models, scored, scored_error(scored, targets, mode)


def scored_error(scored: DataFrame, targets=("x", "y"), mode: str = "mean_sq2d") -> DataFrame:
    matched = scored.select(
        F.col("pred_x").alias("x_pred"),
        F.col("pred_y").alias("y_pred"),
        F.col(targets[0]).alias("x_true"),
        F.col(targets[1]).alias("y_true"),
    )
    return rmse(matched, mode)


def mean_baseline(
    train: DataFrame, held: DataFrame, targets: tuple[str, str] = ("x", "y"), mode: str = "mean_sq2d"
) -> float | None:
    """Error on held rows of always predicting the training rows' mean target."""
    mean = train.agg(*[F.avg(t) for t in targets]).first()
    scored = held.withColumns({"pred_x": F.lit(mean[0]), "pred_y": F.lit(mean[1])})
    return scored_error(scored, targets, mode).first().rmse


def cross_validated_parts(
    df: DataFrame,
    features: list[str],
    targets: tuple[str, str] = ("x", "y"),
    settings: dict | None = None,
    k: int = 3,
    keys: list[str] = TIMELINE_KEYS,
    seed: int = 42,
    mode: str = "elementwise",
) -> list[tuple[str, int, float | None]]:
    """(fold, rows scored, error) of the folds that hold rows; a sequence stays within one fold."""
    folded = fold_column(df, k, keys, seed)

    def part_of(fold: int) -> tuple[str, int, float | None]:
        models = fit_axes(folded.where(F.col("fold") != fold), features, targets, settings)
        held = folded.where(F.col("fold") == fold)
        found = scored_error(score(models, held, features, list(targets)), targets, mode).first()
        return f"fold {fold}", found.n_points, found.rmse

    filled = sorted(r["fold"] for r in folded.select("fold").distinct().collect())  # k rows at most
    if len(filled) < 2:
        raise ValueError("cross-validation needs rows in two folds at least")
    return together(df.sparkSession, [lambda f=f: part_of(f) for f in filled])


def mean_error(parts: list[tuple[str, int, float | None]]) -> float:
    """Mean of the parts' errors, those without a target left out."""
    known = [error for _, _, error in parts if error is not None]
    if not known:
        raise ValueError("no part has a target to score")
    return sum(known) / len(known)


def cross_validated_error(df: DataFrame, features: list[str], *args, **options) -> float:
    """Mean over the folds that hold rows of the error (see `cross_validated_parts`)."""
    return mean_error(cross_validated_parts(df, features, *args, **options))


@dataclass(frozen=True)
class SearchSpace:
    """Values each setting may take, in order; a step goes to a neighbouring value."""

    depth: tuple[int, ...] = (3, 4, 5, 6)
    trees: tuple[int, ...] = (50, 100, 200)
    step: tuple[float, ...] = (0.05, 0.1, 0.2)
    rows: tuple[float, ...] = (0.8, 0.9, 1.0)

    def anywhere(self, rng: random.Random) -> dict[str, int]:
        """A place in the space, as an index per setting."""
        return {name: rng.randrange(len(values)) for name, values in vars(self).items()}

    def beside(self, place: dict[str, int], rng: random.Random) -> dict[str, int]:
        """A place one step away in one setting or more."""
        movable = [name for name, values in vars(self).items() if len(values) > 1]
        moved = dict(place)
        for name in rng.sample(movable, rng.randint(1, len(movable))) if movable else ():
            last = len(getattr(self, name)) - 1
            moved[name] = min(last, max(0, place[name] + (1 if rng.random() < 0.5 else -1)))
        return moved

    def settings(self, place: dict[str, int]) -> dict:
        return {name: getattr(self, name)[at] for name, at in place.items()}


@dataclass
class SearchResult:
    settings: dict
    score: float
    trials: list[tuple[dict, float]]
    parts: list[list[tuple[str, int, float | None]]] = field(default_factory=list)

    def parts_table(self, spark: SparkSession) -> DataFrame:
        """(trial, part, n_rows, error): what each trial was scored on."""
        rows = [(i, *part) for i, parts in enumerate(self.parts, 1) for part in parts]
        return spark.createDataFrame(rows, "trial int, part string, n_rows long, error double")

    def history_table(self, spark: SparkSession) -> DataFrame:
        """One row a trial: number, error and the settings tried."""
        lines = [
            json.dumps({"trial": i, "error": error, **settings})
            for i, (settings, error) in enumerate(self.trials, 1)
        ]
        fields = "trial int, error double, depth int, trees int, step double, rows double"
        parsed = spark.createDataFrame([(line,) for line in lines], "line string")
        return parsed.select(F.inline(F.array(F.from_json("line", fields)))).withColumnRenamed(
            "rows", "row_share"
        )


def search_settings(
    df: DataFrame,
    features: list[str],
    targets: tuple[str, str] = ("x", "y"),
    trials: int = 4,
    k: int | None = 3,
    seed: int = 42,
    space: SearchSpace | None = None,
    per_round: int = 2,
    n_sequences: int | None = None,
    mode: str = "elementwise",
) -> SearchResult:
    """Search by rounds of trials that are fitted side by side.

    The first round is drawn from the whole space; a later round stays around the best place
    so far. Every trial is scored by the same error measure: k-fold, or on one held-out part
    when k is None. n_sequences bounds the labelled sequences that the search draws, by digest.
    """
    space, rng = space or SearchSpace(), random.Random(seed)
    data = df if n_sequences is None else sample_sequences(df, n_sequences, TIMELINE_KEYS, seed)
    data = data.persist()  # read by every trial; rebuilt from lineage when lost

    def parts_of(settings: dict) -> list[tuple[str, int, float | None]]:
        settings = {**settings, "seed": seed}
        if k is not None:
            return cross_validated_parts(data, features, targets, settings, k, seed=seed, mode=mode)
        found = holdout_error(data, features, targets, settings, seed=seed, mode=mode)[2].first()
        return [("held out", found.n_points, found.rmse)]

    scored: list[list[tuple[str, int, float | None]]] = []
    tried: list[tuple[dict, float]] = []
    best_place, best = None, None
    try:
        while len(tried) < trials:
            count = min(per_round, trials - len(tried))
            places = [
                space.anywhere(rng) if best_place is None else space.beside(best_place, rng)
                for _ in range(count)
            ]
            found = together(
                df.sparkSession, [lambda p=p: parts_of(space.settings(p)) for p in places]
            )
            scored += found
            for place, error in zip(places, map(mean_error, found)):
                tried.append((space.settings(place), error))
                if best is None or error < best[1]:
                    best_place, best = place, tried[-1]
    finally:
        data.unpersist()
    if best is None:
        raise ValueError("a search needs one trial at least")
    return SearchResult(best[0], best[1], tried, scored)


def early_stopped_fit(
    df: DataFrame,
    features: list[str],
    targets: tuple[str, str] = ("x", "y"),
    settings: dict | None = None,
    validation_share: float = 0.2,
    seed: int = 42,
) -> AxisModels:
    """Boost until the error on held-out plays no longer falls."""
    parts = split_column(
        df, {"train": 1.0 - validation_share, "validate": validation_share}, seed=seed
    ).withColumn("__validate", F.col("split") == "validate")
    return fit_axes(parts, features, targets, settings, validation="__validate")


@dataclass
class StagedFit:
    """A model cut back to its best round, and the held-out error after every round that was run."""

    models: AxisModels
    best_round: dict[str, int]
    rounds_run: dict[str, int]
    errors: dict[str, list[float]]

    def history_table(self, spark: SparkSession) -> DataFrame:
        """(axis, round, error, kept), a row for each boosting round."""
        rows = [
            (axis, n, error, n <= self.best_round[axis])
            for axis, errors in self.errors.items()
            for n, error in enumerate(errors, 1)
        ]
        return spark.createDataFrame(rows, "axis string, round int, error double, kept boolean")


def best_round(errors: list[float], patience: int) -> tuple[int, int]:
    """(round of the least error before patience ran out, rounds looked at), both from 1."""
    best = 0
    for n, error in enumerate(errors):
        if error < errors[best]:
            best = n
        elif n - best >= patience:
            return best + 1, n + 1
    return best + 1, len(errors)


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model after its first n rounds."""
    gateway = SparkContext._active_spark_context._gateway
    java = model._java_obj
    kind = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = gateway.new_array(kind, n), gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        trees[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    cut = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights, model.numFeatures)
    out = GBTRegressionModel(cut)
    out._resetUid(model.uid)
    model._copyValues(out)
    return out


def staged_fit(
    df: DataFrame,
    features: list[str],
    targets: tuple[str, str] = ("x", "y"),
    settings: dict | None = None,
    validation_share: float = 0.2,
    patience: int = 10,
    seed: int = 42,
) -> StagedFit:
    """Boost all rounds, then keep those up to the best one on held-out plays.

    The held-out error (root mean square) is taken after every round; once `patience` rounds in a
    row have not bettered it, later rounds do not count.
    """
    parts = split_column(df, {"train": 1.0 - validation_share, "validate": validation_share}, seed=seed)
    fitted = fit_axes(parts.where("split = 'train'"), features, targets, settings)
    held = parts.where("split = 'validate'").select(*features, *targets).dropna(subset=list(targets))
    held = held.withColumns({c: S.zero_if_not_finite(F.col(c)) for c in features})
    cut, best, run, errors = {}, {}, {}, {}
    for axis, target, pipeline in (("x", targets[0], fitted.x), ("y", targets[1], fitted.y)):
        assembler, trees = pipeline.stages
        # One pass over the held-out rows gives the errors of all rounds.
        rows = assembler.transform(held).withColumn(target, F.col(target).cast("double"))
        squares = trees.evaluateEachIteration(rows.select(trees.getFeaturesCol(), target), "squared")
        every = [v**0.5 for v in squares]
        best[axis], run[axis] = best_round(every, patience)
        errors[axis] = every[: run[axis]]
        cut[axis] = PipelineModel([assembler, first_trees(trees, best[axis])])
    return StagedFit(AxisModels(cut["x"], cut["y"], list(features)), best, run, errors)


def save_bundle(models: AxisModels, index: DataFrame, scaler, path: str) -> None:
    """Store models, player index and scaling statistics together."""
    models.save(f"{path}/models")
    index.write.mode("overwrite").parquet(f"{path}/player_index")
    scaler.as_table(index.sparkSession).write.mode("overwrite").parquet(f"{path}/scaling")


def load_bundle(spark: SparkSession, path: str):
    from gridmotion.operators.normalize import Scaler

    return (
        AxisModels.load(f"{path}/models"),
        spark.read.parquet(f"{path}/player_index"),
        Scaler.from_table(spark.read.parquet(f"{path}/scaling")),
    )


def kinematic_projection(
    tracking: DataFrame,
    convention: str = "compass",
    with_acceleration: bool = False,
    tick: float = TICK_SECONDS,
) -> DataFrame:
    """Carry each predicted player's last state forward over its output frames 1..n."""
    last = last_states(tracking).where("player_to_predict")
    vx, vy = S.heading_components(F.col("s"), F.col("dir"), convention)
    ax, ay = S.heading_components(F.col("a"), F.col("dir"), convention)
    frames = F.when(F.col("num_frames_output") > 0, F.sequence(F.lit(1), F.col("num_frames_output")))
    moving = last.select(
        *TIMELINE_KEYS,
        "x",
        "y",
        vx.alias("vx"),
        vy.alias("vy"),
        ax.alias("ax"),
        ay.alias("ay"),
        F.explode(frames).alias("frame_id"),
    )
    t = F.col("frame_id") * F.lit(tick)

    def at(position: str, velocity: str, acceleration: str):
        out = F.col(position) + F.col(velocity) * t
        if with_acceleration:
            out = out + F.col(acceleration) * t * t * 0.5
        return out

    return moving.select(
        *TIMELINE_KEYS,
        "frame_id",
        at("x", "vx", "ax").alias("pred_x"),
        at("y", "vy", "ay").alias("pred_y"),
    )
