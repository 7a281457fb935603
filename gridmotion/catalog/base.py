"""Query registry and the tracking tables that Spark derives from `events`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
UNROUNDED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# One play is 264 consecutive events: 12 frames of 22 players; one game is 10 plays.
# The same text serves both engines.
TRACKING_FIELDS = {
    "game_id": "CAST(2024000000 + floor(event_id / 2640) AS BIGINT)",
    "play_id": "CAST(floor(event_id / 264) % 10 + 1 AS BIGINT)",
    "player_to_predict": "(event_id % 22) IN (1, 2, 11, 12)",
    "nfl_id": "CAST(1000 + event_id % 22 + 22 * (floor(event_id / 2640) % 5) AS BIGINT)",
    "frame_id": "CAST(floor((event_id % 264) / 22) + 1 AS INT)",
    "play_direction": "CASE WHEN floor(event_id / 264) % 2 = 0 THEN 'left' ELSE 'right' END",
    "absolute_yardline_number": "CAST(10 + (floor(event_id / 264) * 7) % 100 AS INT)",
    "player_name": "concat('player ', CAST(event_id % 22 AS VARCHAR(10)))",
    "player_height": "CASE WHEN event_id % 22 = 21 THEN 'bad' ELSE concat(CAST(5 + event_id % 2"
    " AS VARCHAR(10)), '-', CAST((event_id % 22) % 12 AS VARCHAR(10))) END",
    "player_weight": "CAST(180 + 7 * (event_id % 22) AS INT)",
    "player_birth_date": "DATE '1990-01-01' + CAST(97 * (event_id % 22) AS INT)",
    "player_position": "CASE WHEN event_id % 22 < 11 THEN 'WR' ELSE 'CB' END",
    "player_side": "CASE WHEN event_id % 22 < 11 THEN 'Offense' ELSE 'Defense' END",
    "player_role": "CASE WHEN event_id % 22 = 1 THEN 'Targeted Receiver' ELSE 'Other' END",
    "x": "10e0 + value % 100e0",
    "y": "(value * 7e0) % 53.3e0",
    "s": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE (value * 3e0) % 10e0 END",
    "a": "(value * 5e0) % 8e0",
    "dir": "(value * 11e0) % 360e0",
    "o": "(value * 13e0) % 360e0",
    "num_frames_output": "CAST(8 + floor(event_id / 264) % 5 AS INT)",
    "ball_land_x": "CAST(20 + (floor(event_id / 264) * 13) % 80 AS DOUBLE)",
    "ball_land_y": "CAST((floor(event_id / 264) * 17) % 53 AS DOUBLE)",
    "week": "CAST(floor(event_id / 2640) % 18 + 1 AS INT)",
    "label_x": "10e0 + (value * 17e0) % 100e0",
    "label_y": "(value * 19e0) % 53.3e0",
}

# Wide integers on the SQL side, where results are compared.
_SQL_FIELDS = ", ".join(
    f"{text if name == 'player_birth_date' else text.replace('AS INT)', 'AS BIGINT)')} AS {name}"
    for name, text in TRACKING_FIELDS.items()
)

CTES = {
    "base": f"SELECT {_SQL_FIELDS} FROM events",
    "tracking": "SELECT * EXCLUDE (label_x, label_y) FROM base",
    "labels": """SELECT game_id, play_id, nfl_id, frame_id, label_x AS x, label_y AS y, week
  FROM base WHERE player_to_predict AND frame_id <= num_frames_output""",
    # Mirrored coordinates, as the tables use them.
    "norm": """SELECT *,
  CASE WHEN play_direction = 'left' THEN 120e0 - x ELSE x END AS x_norm,
  CASE WHEN play_direction = 'left' THEN 160e0/3e0 - y ELSE y END AS y_norm,
  CASE WHEN play_direction = 'left' THEN (dir + 180e0) % 360e0 ELSE dir END AS dir_norm,
  CASE WHEN play_direction = 'left' THEN (o + 180e0) % 360e0 ELSE o END AS o_norm
  FROM tracking""",
}


def with_ctes(names: list[str], body: str) -> str:
    """Prefix body with the named tables; a body may bring further ones of its own."""
    parts = ", ".join(f"{n} AS ({CTES[n]})" for n in names)
    body = body.strip()
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(opening):
            return f"{opening}{parts}, {body[len(opening):]}"
    return f"WITH {parts} {body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        *[f"{text} AS {name}" for name, text in TRACKING_FIELDS.items()]
    )


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir).drop("label_x", "label_y")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _base(spark, sf_dir).where("player_to_predict AND frame_id <= num_frames_output")
    return rows.select(
        "game_id",
        "play_id",
        "nfl_id",
        "frame_id",
        F.col("label_x").alias("x"),
        F.col("label_y").alias("y"),
        "week",
    )


def r6(col: Column) -> Column:
    """Round to 6 places; -0.0 becomes 0.0 and missing stays apart from NaN."""
    return F.round(col, 6) + F.lit(0.0)


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles, widen integers and spell dates out, for comparison between engines."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(r6(F.col(f.name).cast("double")).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = ()):
    """Register a query; sql may use the tables tracking, labels and those named in ctes."""

    def register(fn):
        UNROUNDED[name] = fn
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_ctes(["base", "tracking", "labels", *ctes], sql)
        return fn

    return register


def q(*columns: str) -> str:
    """SQL for rounded doubles: 'expr AS name' items."""
    out = []
    for item in columns:
        expr, name = item.rsplit(" AS ", 1)
        out.append(f"round({expr}, 6) + 0e0 AS {name}")
    return ", ".join(out)
