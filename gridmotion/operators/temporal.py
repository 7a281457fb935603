"""Per-player time features: rolling statistics, differences, lags."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from gridmotion.functions import scalars as S
from gridmotion.operators.skew import MAX_TIMELINE_ROWS, over_timelines
from gridmotion.schemas import TIMELINE_KEYS


def _full_window(stat, column: str, window: WindowSpec, size: int):
    """stat over the last `size` rows, null until they hold `size` non-null values."""
    last = window.rowsBetween(1 - size, 0)
    return F.when(F.count(column).over(last) == size, stat(column).over(last))


def temporal_features(
    df: DataFrame,
    window_sizes: tuple[int, ...] = (3, 5),
    keys: list[str] = TIMELINE_KEYS,
    order: tuple[str, ...] = ("frame_id",),
    s: str = "s",
    a: str = "a",
    direction: str = "dir",
    x: str = "x",
    y: str = "y",
    max_rows: int = MAX_TIMELINE_ROWS,
) -> DataFrame:
    """Rolling mean/deviation of speed and acceleration, turn rate, steps, path length."""

    def compute(rows: DataFrame, window: WindowSpec) -> DataFrame:
        new = {}
        for size in window_sizes:
            for label, column in (("speed", s), ("accel", a)):
                new[f"{label}_rolling_mean_{size}"] = _full_window(F.avg, column, window, size)
                new[f"{label}_rolling_std_{size}"] = _full_window(
                    F.stddev_samp, column, window, size
                )
        turn = F.col(direction) - F.lag(direction).over(window)
        new["angular_velocity"] = F.pmod(turn + 180.0, F.lit(360.0)) - 180.0
        new["delta_x"] = F.col(x) - F.lag(x).over(window)
        new["delta_y"] = F.col(y) - F.lag(y).over(window)
        return rows.withColumns(new)

    return over_timelines(
        df,
        keys,
        list(order),
        lookback=max([1, *[size - 1 for size in window_sizes]]),
        compute=compute,
        running={"cumulative_distance": S.euclidean(F.col("delta_x"), F.col("delta_y"))},
        max_rows=max_rows,
    )


def prior_features(
    df: DataFrame,
    n_priors: int,
    keys: list[str] = TIMELINE_KEYS,
    order: tuple[str, ...] = ("frame_id",),
    x: str = "x",
    y: str = "y",
    max_rows: int = MAX_TIMELINE_ROWS,
) -> DataFrame:
    """Add x_prior1..n and y_prior1..n; rows without a full history are left out."""

    def compute(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumns(
            {
                f"{label}_prior{k}": F.lag(column, k).over(window)
                for k in range(1, n_priors + 1)
                for label, column in (("x", x), ("y", y))
            }
        )

    out = over_timelines(df, keys, list(order), n_priors, compute, max_rows=max_rows)
    return out.dropna(subset=[f"x_prior{n_priors}", f"y_prior{n_priors}"])
