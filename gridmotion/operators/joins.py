"""Joins between tracking, label, feature and prediction tables.

Nothing here is forced to broadcast: lookup sides go over when Spark measures them as small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmotion.operators.rollups import last_known_position, last_states
from gridmotion.schemas import (
    PLAY_KEYS,
    ROW_KEYS,
    SIDE_FRAME_KEYS,
    TEAMFRAME_FEATURES,
    TIMELINE_KEYS,
    require_columns,
)


def suffixed(df: DataFrame, columns: list[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in columns})


def frame_aligned_join(tracking: DataFrame, labels: DataFrame) -> DataFrame:
    """Input frame k beside label frame k, label columns suffixed; see t0_join for the throw-aligned pairing."""
    right = suffixed(labels.select(*ROW_KEYS, "x", "y"), ["x", "y"], "_label")
    return tracking.join(right, ROW_KEYS)


def with_last_label(tracking: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the last known label position (tx, ty) of the player's timeline, null without labels."""
    return tracking.join(last_known_position(labels), TIMELINE_KEYS, "left")


def t0_join(tracking: DataFrame, labels: DataFrame) -> DataFrame:
    """Every label row beside the player's last input frame, clashing columns suffixed _t0."""
    t0 = last_states(tracking.where("player_to_predict"))
    clash = [c for c in t0.columns if c in labels.columns and c not in TIMELINE_KEYS]
    joined = labels.join(suffixed(t0, clash, "_t0"), TIMELINE_KEYS)
    return joined.withColumn("rel_frame", F.col("frame_id"))


def join_teamframe(players: DataFrame, teamframe: DataFrame) -> DataFrame:
    """Team features on every player row; missing team features become 0."""
    require_columns(teamframe, [*SIDE_FRAME_KEYS, *TEAMFRAME_FEATURES], "team-frame table")
    joined = players.join(
        teamframe.select(*SIDE_FRAME_KEYS, *TEAMFRAME_FEATURES), SIDE_FRAME_KEYS, "left"
    )
    return joined.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in TEAMFRAME_FEATURES}
    )


def full_join_plays(left: DataFrame, right: DataFrame, keys: list[str] = PLAY_KEYS) -> DataFrame:
    return left.join(right, keys, "full")


def only_labelled_players(tracking: DataFrame, labels: DataFrame, pid: str = "nfl_id") -> DataFrame:
    return tracking.join(labels.select(pid).distinct(), pid, "left_semi")


def restrict_to_keys(df: DataFrame, keys_table: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(keys_table.select(*keys), keys, "left_semi")


def predictions_with_truth(
    predictions: DataFrame, truth: DataFrame, keys: list[str] = ROW_KEYS
) -> DataFrame:
    """Predicted and true x, y side by side, suffixed _pred and _true."""
    pred = predictions.withColumnsRenamed({"pred_x": "x", "pred_y": "y"})
    return suffixed(pred.select(*keys, "x", "y"), ["x", "y"], "_pred").join(
        suffixed(truth.select(*keys, "x", "y"), ["x", "y"], "_true"), keys
    )


def with_player_index(df: DataFrame, index: DataFrame, unknown: str = "skip") -> DataFrame:
    """Attach the dense player index; unknown players are skipped or get index 0."""
    if unknown == "skip":
        return df.join(index, "nfl_id")
    if unknown == "zero":
        joined = df.join(index, "nfl_id", "left")
        return joined.withColumn("player_idx", F.coalesce(F.col("player_idx"), F.lit(0)))
    raise ValueError(f"unknown must be 'skip' or 'zero', got {unknown!r}")


def with_peak_acceleration(states: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Attach each player's acceleration quantile to the last state."""
    return states.join(quantiles, "nfl_id", "left")
