"""The feature tables and model-ready tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmotion.operators import joins, rollups
from gridmotion.operators.normalize import player_scalars, present_columns, rightward
from gridmotion.operators.skew import dense_index
from gridmotion.operators.spatial import shape_and_coverage, side_shapes
from gridmotion.operators.temporal import prior_features, temporal_features
from gridmotion.schemas import (
    FRAME_KEYS,
    MODEL_FEATURES,
    PLAY_KEYS,
    PLAYER_COLUMNS,
    SIDES,
    T0_FEATURES,
    require_columns,
)

COVERAGE_RADII = (3.0, 5.0, 7.0)


def players_table(tracking: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per player and frame; one shuffle, by player timeline.

    The scalars come after the time features, so their columns are never shuffled. keep
    names further input columns to carry along.
    """
    timed = temporal_features(
        rightward(tracking), (3, 5), direction="dir_norm", x="x_norm", y="y_norm"
    )
    return present_columns(player_scalars(timed), [*PLAYER_COLUMNS, *keep])


def teamframe_table(tracking: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per side and frame; rows move once, by frame, then only their sums.

    keep names columns that are constant within a play, to carry along.
    """
    rows = rightward(tracking).select(
        *FRAME_KEYS, "player_side", "nfl_id", "x_norm", "y_norm", *keep
    )
    covered = shape_and_coverage(
        rows, COVERAGE_RADII, FRAME_KEYS, "player_side", "nfl_id", "x_norm", "y_norm"
    )
    return rollups.team_frame_rollup(covered, keep)


def plays_table(players: DataFrame, teamframe: DataFrame, sides: tuple[str, ...] = SIDES) -> DataFrame:
    """One row per play: each side's motion and shape in its last frame.

    Of teamframe only the formation width and depth are used.
    """
    return joins.full_join_plays(
        rollups.last_motion_by_side(players, sides), rollups.last_shape_by_side(teamframe, sides)
    )


def feature_tables(tracking: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """players, teamframe and plays as lazy tables over the whole input.

    plays needs only the sides' motion and shape, so it does not wait for the other two.
    """
    return players_table(tracking), teamframe_table(tracking), plays_from_tracking(tracking)


def plays_from_tracking(tracking: DataFrame) -> DataFrame:
    """The play table straight from tracking rows: aggregations only."""
    rows = rightward(tracking)
    return plays_table(rows, side_shapes(rows, x="x_norm", y="y_norm"))


def t0_training_table(tracking: DataFrame, labels: DataFrame) -> DataFrame:
    """Label rows with the player's state at the throw as features."""
    joined = joins.t0_join(tracking, labels)
    return joined.select(*PLAY_KEYS, "nfl_id", "frame_id", *T0_FEATURES, "x", "y")


def lag_features(columns: list[str], n_priors: int) -> list[str]:
    """Lag columns, then those of s, a, dir, o that exist."""
    lags = [f"{axis}_prior{k}" for k in range(1, n_priors + 1) for axis in ("x", "y")]
    return lags + [c for c in ("s", "a", "dir", "o") if c in columns]


def lag_training_table(rows: DataFrame, n_priors: int = 5) -> DataFrame:
    lagged = prior_features(rows, n_priors)
    features = lag_features(lagged.columns, n_priors)
    return lagged.select(*PLAY_KEYS, "nfl_id", "frame_id", *features, "x", "y")


def model_table(players: DataFrame, teamframe: DataFrame) -> DataFrame:
    """Player rows with team features, checked to hold every model feature."""
    return require_columns(joins.join_teamframe(players, teamframe), MODEL_FEATURES, "model table")


def player_index(*tables: DataFrame) -> DataFrame:
    """Dense index of all players in id order: (nfl_id, player_idx)."""
    ids = rollups.distinct_players(*tables).where(F.col("nfl_id").isNotNull())
    return dense_index(ids, ["nfl_id"], "player_idx")
