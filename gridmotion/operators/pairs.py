"""Pairs of players of a frame as rows, and the ball's place in every frame of its flight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmotion.functions import scalars as S
from gridmotion.schemas import FRAME_KEYS

SPAN_ROWS = 1024  # frames that one row becomes at a time


def frame_pairs(
    df: DataFrame,
    radius: float | None = None,
    frame_keys: list[str] = FRAME_KEYS,
    side: str = "player_side",
    pid: str = "nfl_id",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Ordered pairs of different players of a frame: frame, pid, other_pid, same_side, distance.

    With a radius only pairs closer than it, found over grid cells of that size: a player meets
    the nine cells around its own, so a crowded frame never meets itself whole. Without one, all
    pairs; a missing place then gives a pair without a distance. No job runs before the rows are
    asked for. Rows with a missing frame or player are in no pair.
    """
    known = df.dropna(subset=[*frame_keys, pid]).select(
        *frame_keys, F.col(side).alias("side"), F.col(pid).alias("pid"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    on = list(frame_keys)
    left, right = known, known
    if radius is not None:
        if not radius > 0:
            raise ValueError(f"a radius must be above 0, got {radius!r}")
        cell = lambda c: F.floor(F.col(c) / F.lit(float(radius)))
        cells = known.where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
        cells = cells.withColumns({"cx": cell("x"), "cy": cell("y")})
        around = F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
        left = cells.select(*frame_keys, "side", "pid", "x", "y", F.inline(around))
        right, on = cells, [*on, "cx", "cy"]
    other = right.select(*on, *[F.col(c).alias(f"other_{c}") for c in ("side", "pid", "x", "y")])
    distance = S.euclidean(F.col("x") - F.col("other_x"), F.col("y") - F.col("other_y"))
    met = left.join(other, on).where(F.col("pid") != F.col("other_pid"))
    met = met.select(
        *frame_keys, F.col("pid").alias(pid), F.col("other_pid").alias(f"other_{pid}"), (F.col("side") == F.col("other_side")).alias("same_side"), distance.alias("distance")
    )
    return met if radius is None else met.where(F.col("distance") < radius)


def players_within(
    df: DataFrame,
    radii: tuple[float, ...] = (3.0, 5.0, 7.0),
    frame_keys: list[str] = FRAME_KEYS,
    side: str = "player_side",
    pid: str = "nfl_id",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Teammates and opponents closer than each radius, for every player of a frame; 0 where nobody is.

    Takes work in proportion to the pairs within the largest radius, however crowded a frame is.
    """
    near = frame_pairs(df, max(radii), frame_keys, side, pid, x, y)
    counts = []
    for r in radii:
        for label, same in (("opponents", False), ("teammates", True)):
            hit = (F.col("distance") < r) & (F.col("same_side") == F.lit(same))
            counts.append(F.sum(hit.cast("long")).alias(f"{label}_within_{int(r)}yds"))
    names = [f"{label}_within_{int(r)}yds" for r in radii for label in ("opponents", "teammates")]
    found = near.groupBy(*frame_keys, pid).agg(*counts)
    players = df.dropna(subset=[*frame_keys, pid]).select(*frame_keys, pid).distinct()
    out = players.join(found, [*frame_keys, pid], "left")
    return out.select(*frame_keys, pid, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names])


def spans_to_frames(df: DataFrame, n_frames: Column, frame: str = "frame", span_rows: int = SPAN_ROWS) -> DataFrame:
    """Each row once for every frame 1 to n_frames; rows of long spans are split before, and dealt out.

    Rows whose n_frames is missing or below 1 become no frame.
    """
    length = n_frames.cast("long")
    spans = df.withColumn("__n", length).where(F.col("__n") >= 1)
    starts = F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(span_rows).cast("long"))
    spans = spans.withColumn("__start", F.explode(starts))
    last = F.least(F.col("__start") + span_rows, F.col("__n"))
    return spans.withColumn(frame, F.explode(F.sequence(F.col("__start") + 1, last))).drop("__n", "__start")


def ball_path(
    df: DataFrame,
    keys: list[str],
    start: tuple[str, str] = ("x", "y"),
    land: tuple[str, str] = ("ball_land_x", "ball_land_y"),
    n_frames: str = "num_frames_output",
    frame: str = "frame",
) -> DataFrame:
    """Place of the ball in every frame of its flight: keys, frame (from 1), ball_x and ball_y.

    df has a row for each flight. The ball goes straight from start to land and is there in the
    last frame. Where any of its numbers is missing, both coordinates are NaN.
    """
    rows = spans_to_frames(df, F.col(n_frames), frame)
    at = S.ball_position(*[F.col(c) for c in (*start, *land, frame, n_frames)])
    return rows.select(*keys, F.col(frame), at[0].alias("ball_x"), at[1].alias("ball_y"))
