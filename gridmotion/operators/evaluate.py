"""Trajectory error measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmotion.operators.joins import predictions_with_truth
from gridmotion.schemas import PLAY_KEYS, ROW_KEYS

RMSE_MODES = ("mean_sq2d", "half", "elementwise", "elementwise_half")


def squared_error(
    pred: tuple[str, str] = ("x_pred", "y_pred"), truth: tuple[str, str] = ("x_true", "y_true")
) -> Column:
    dx, dy = F.col(pred[0]) - F.col(truth[0]), F.col(pred[1]) - F.col(truth[1])
    return dx * dx + dy * dy


def _from_mean_square(mean_square: Column, mode: str) -> Column:
    """mean_square is the mean of dx^2 + dy^2 over points."""
    if mode not in RMSE_MODES:
        raise ValueError(f"unknown rmse mode {mode!r}")
    factor = {"mean_sq2d": 1.0, "half": 0.5, "elementwise": 0.5, "elementwise_half": 0.25}[mode]
    return F.sqrt(mean_square * F.lit(factor))


def rmse(matched: DataFrame, mode: str = "mean_sq2d", by: list[str] | None = None) -> DataFrame:
    """Root mean squared error over matched rows, in all or per group."""
    value = _from_mean_square(F.avg(squared_error()), mode).alias("rmse")
    grouped = matched.groupBy(*by) if by else matched.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n_points"), value)


def all_rmse_modes(matched: DataFrame) -> DataFrame:
    """(mode, n_points, rmse) of every mode from one pass: they differ by a factor."""
    one = matched.agg(F.count(F.lit(1)).alias("n_points"), F.avg(squared_error()).alias("__mean"))
    rows = [
        F.struct(F.lit(mode).alias("mode"), "n_points", _from_mean_square(F.col("__mean"), mode).alias("rmse"))
        for mode in RMSE_MODES
    ]
    return one.select(F.inline(F.array(*rows)))


def play_averaged_rmse(matched: DataFrame, keys: list[str] = PLAY_KEYS) -> DataFrame:
    """Mean over plays of each play's error."""
    per_play = matched.groupBy(*keys).agg(F.sqrt(F.avg(squared_error())).alias("rmse"))
    return per_play.agg(F.count(F.lit(1)).alias("n_plays"), F.avg("rmse").alias("rmse"))


def padded_rmse(
    matched: DataFrame, sequence_keys: list[str], length: int, mode: str = "elementwise"
) -> DataFrame:
    """Error when every sequence counts `length` points, the padded ones with error 0."""
    per_sequence = matched.groupBy(*sequence_keys).agg(F.sum(squared_error()).alias("sq"))
    mean_square = F.sum("sq") / (F.count(F.lit(1)) * F.lit(length))
    return per_sequence.agg(
        F.count(F.lit(1)).alias("n_sequences"), _from_mean_square(mean_square, mode).alias("rmse")
    )


def evaluate_predictions(
    predictions: DataFrame,
    truth: DataFrame,
    mode: str = "mean_sq2d",
    by_play: bool = False,
    keys: list[str] = ROW_KEYS,
) -> DataFrame:
    """Match predictions to truth on keys and report the error, in all or per play."""
    matched = predictions_with_truth(predictions, truth, keys)
    return rmse(matched, mode, PLAY_KEYS if by_play else None)


def mean_fold_score(scores: DataFrame, column: str = "rmse") -> DataFrame:
    return scores.agg(F.avg(column).alias("mean_score"), F.count(F.lit(1)).alias("n_folds"))
