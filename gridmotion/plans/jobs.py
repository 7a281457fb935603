"""Whole runs from stored data to an error figure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmotion.operators import models
from gridmotion.operators.evaluate import evaluate_predictions, play_averaged_rmse
from gridmotion.operators.joins import predictions_with_truth
from gridmotion.operators.quality import assert_prediction_counts
from gridmotion.plans.tables import lag_features, lag_training_table, t0_training_table
from gridmotion.schemas import PLAY_KEYS, ROW_KEYS, T0_FEATURES
from gridmotion.sources import files


def lag_model_error(
    spark: SparkSession,
    csv_path: str,
    n_priors: int = 5,
    metric_path: str | None = None,
    settings: dict | None = None,
    split_keys: list[str] | None = None,
) -> tuple[float, DataFrame]:
    """Boosted trees on lag features of a combined CSV: (hold-out error, scored test rows)."""
    rows = lag_training_table(files.read_untyped_csv(spark, csv_path), n_priors)
    features = lag_features(rows.columns, n_priors)
    _, scored, error = models.holdout_error(
        rows, features, settings=settings, split_keys=split_keys or PLAY_KEYS
    )
    if metric_path:
        metric = error.select(F.lit("lag_model_rmse").alias("metric"), F.col("rmse").alias("value"))
        files.append_metric(metric, metric_path)
    return error.first().rmse, scored


def t0_model_error(
    tracking: DataFrame, labels: DataFrame, settings: dict | None = None
) -> tuple[float, float]:
    """Boosted trees on throw-time features, scored on their training rows.

    Returns the error over all points and the mean of the plays' errors.
    """
    rows = t0_training_table(tracking, labels)
    fitted = models.fit_axes(rows, T0_FEATURES, settings={**models.T0_SETTINGS, **(settings or {})})
    scored = models.score(fitted, rows, T0_FEATURES, ROW_KEYS)
    matched = predictions_with_truth(scored, labels)
    overall = evaluate_predictions(scored, labels).first().rmse
    return overall, play_averaged_rmse(matched).first().rmse


def kinematic_error(
    tracking: DataFrame, labels: DataFrame, predictions_path: str | None = None
) -> tuple[float, DataFrame]:
    """Kinematic baseline: (error per coordinate, predictions beside truth).

    A play with another number of predictions than of labels is an error.
    """
    predictions = models.kinematic_projection(tracking)
    assert_prediction_counts(predictions, labels)
    if predictions_path:
        files.write_csv(predictions, predictions_path)
    matched = predictions_with_truth(predictions, labels)
    return evaluate_predictions(predictions, labels, "half").first().rmse, matched
