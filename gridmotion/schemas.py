"""Table schemas, key sets and field constants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Playing-field size used for mirroring, and the label scale.
# The two widths differ on purpose (160/3 against 53.3).
FIELD_LENGTH = 120.0
FIELD_WIDTH = 160.0 / 3.0
LABEL_SCALE_X = 120.0
LABEL_SCALE_Y = 53.3

# Tick length in seconds, reference date for ages, test-set week.
TICK_SECONDS = 0.1
AGE_REFERENCE_DATE = "2023-09-01"
TEST_WEEK = -1

# Names as they stand in the data.
OFFENSE = "Offense"
DEFENSE = "Defense"
SIDES = (OFFENSE, DEFENSE)
TARGETED_RECEIVER = "Targeted Receiver"

PLAY_KEYS = ["game_id", "play_id"]
FRAME_KEYS = ["game_id", "play_id", "frame_id"]
SIDE_KEYS = ["game_id", "play_id", "player_side"]
SIDE_FRAME_KEYS = ["game_id", "play_id", "frame_id", "player_side"]
TIMELINE_KEYS = ["game_id", "play_id", "nfl_id"]
ROW_KEYS = ["game_id", "play_id", "nfl_id", "frame_id"]


def _schema(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_LONG, _INT, _DOUBLE, _TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

# Columns and types of the raw tracking and label files.
TRACKING_SCHEMA = _schema(
    [
        ("game_id", _LONG),
        ("play_id", _LONG),
        ("player_to_predict", T.BooleanType()),
        ("nfl_id", _LONG),
        ("frame_id", _INT),
        ("play_direction", _TEXT),
        ("absolute_yardline_number", _INT),
        ("player_name", _TEXT),
        ("player_height", _TEXT),
        ("player_weight", _INT),
        ("player_birth_date", T.DateType()),
        ("player_position", _TEXT),
        ("player_side", _TEXT),
        ("player_role", _TEXT),
        ("x", _DOUBLE),
        ("y", _DOUBLE),
        ("s", _DOUBLE),
        ("a", _DOUBLE),
        ("dir", _DOUBLE),
        ("o", _DOUBLE),
        ("num_frames_output", _INT),
        ("ball_land_x", _DOUBLE),
        ("ball_land_y", _DOUBLE),
    ]
)

LABEL_SCHEMA = _schema(
    [
        ("game_id", _LONG),
        ("play_id", _LONG),
        ("nfl_id", _LONG),
        ("frame_id", _INT),
        ("x", _DOUBLE),
        ("y", _DOUBLE),
    ]
)

# Columns of the feature tables, in table order.
TEMPORAL_COLUMNS = [
    "speed_rolling_mean_3",
    "speed_rolling_std_3",
    "accel_rolling_mean_3",
    "accel_rolling_std_3",
    "speed_rolling_mean_5",
    "speed_rolling_std_5",
    "accel_rolling_mean_5",
    "accel_rolling_std_5",
    "angular_velocity",
    "delta_x",
    "delta_y",
    "cumulative_distance",
]

PLAYER_COLUMNS = [
    *FRAME_KEYS,
    "nfl_id",
    "player_side",
    "player_role",
    "player_position",
    "player_to_predict",
    "x_norm",
    "y_norm",
    "dir_norm",
    "o_norm",
    "s",
    "a",
    "vx",
    "vy",
    "ax",
    "ay",
    "dir_sin",
    "dir_cos",
    "o_sin",
    "o_cos",
    "height_in",
    "player_weight",
    "player_age",
    "player_bmi",
    "absolute_yardline_number",
    "num_frames_output",
    "ball_land_x",
    "ball_land_y",
    *TEMPORAL_COLUMNS,
]

TEAMFRAME_FEATURES = [
    "formation_width",
    "formation_depth",
    "formation_x_mean",
    "formation_y_mean",
    "team_spread_mean",
    "depth_std",
    "width_std",
    "nn_teammate_mean",
    "nn_opponent_mean",
    "coverage_density_mean",
    "opp_within_3yds_sum",
    "opp_within_5yds_sum",
    "opp_within_7yds_sum",
    "tm_within_3yds_sum",
    "tm_within_5yds_sum",
    "tm_within_7yds_sum",
]

# Feature lists of the sequence, raw-sequence and throw-time models.
SEQUENCE_BASE_FEATURES = [
    "x_norm",
    "y_norm",
    "dir_norm",
    "o_norm",
    "s",
    "a",
    "vx",
    "vy",
    "ax",
    "ay",
    "dir_sin",
    "dir_cos",
    "o_sin",
    "o_cos",
    "absolute_yardline_number",
]
MODEL_FEATURES = SEQUENCE_BASE_FEATURES + TEAMFRAME_FEATURES

RAW_SEQUENCE_FEATURES = ["x", "y", "s", "a", "dir", "o", "absolute_yardline_number"]

T0_FEATURES = [
    "x_t0",
    "y_t0",
    "s",
    "a",
    "o",
    "dir",
    "player_weight",
    "absolute_yardline_number",
    "rel_frame",
    "num_frames_output",
]


def require_columns(df: DataFrame, columns: list[str], what: str = "table") -> DataFrame:
    """Return df, or raise naming every missing column."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df
