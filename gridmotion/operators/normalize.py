"""Row-wise operators: mirroring, player scalars, filters, fills, z-scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmotion.functions import scalars as S
from gridmotion.schemas import FIELD_LENGTH, FIELD_WIDTH, PLAY_KEYS, require_columns

NORM_COLUMNS = ["x_norm", "y_norm", "dir_norm", "o_norm"]


def rightward(df: DataFrame, wrap: bool = False) -> DataFrame:
    """Add x_norm, y_norm, dir_norm, o_norm with the offence always moving right."""
    require_columns(df, ["x", "y", "dir", "o", "play_direction"], "tracking table")
    if wrap:
        values = S.normalize_rightward(
            F.col("x"), F.col("y"), F.col("dir"), F.col("o"), F.col("play_direction")
        )
        return df.withColumns(dict(zip(NORM_COLUMNS, values)))
    left = S.moves_left(F.col("play_direction"))
    return df.withColumns(
        {
            "x_norm": S.mirror_length(F.col("x"), left, FIELD_LENGTH),
            "y_norm": S.mirror_length(F.col("y"), left, FIELD_WIDTH),
            "dir_norm": S.mirror_angle(F.col("dir"), left),
            "o_norm": S.mirror_angle(F.col("o"), left),
        }
    )


def ensure_rightward(df: DataFrame) -> DataFrame:
    """Keep existing normalised columns, else derive them with wrapped angles."""
    if set(NORM_COLUMNS) <= set(df.columns):
        return df
    return rightward(df, wrap=True)


def player_scalars(df: DataFrame) -> DataFrame:
    """Body measures, heading sine/cosine and velocity/acceleration components."""
    df = df.withColumns(
        {
            "height_in": S.height_to_inches(F.col("player_height")),
            "player_age": S.age_years(F.col("player_birth_date")),
            "dir_sin": S.sin_deg(F.col("dir_norm")),
            "dir_cos": S.cos_deg(F.col("dir_norm")),
            "o_sin": S.sin_deg(F.col("o_norm")),
            "o_cos": S.cos_deg(F.col("o_norm")),
        }
    )
    return df.withColumns(
        {
            "player_bmi": S.bmi(F.col("player_weight"), F.col("height_in")),
            "vx": F.col("s") * F.col("dir_cos"),
            "vy": F.col("s") * F.col("dir_sin"),
            "ax": F.col("a") * F.col("dir_cos"),
            "ay": F.col("a") * F.col("dir_sin"),
        }
    )


def only_side(df: DataFrame, side: str | None, column: str = "player_side") -> DataFrame:
    return df if side is None else df.where(F.col(column) == side)


def only_side_any_case(df: DataFrame, side: str, column: str = "player_side") -> DataFrame:
    require_columns(df, [column])
    return df.where(F.lower(column) == side.lower())


def to_predict(df: DataFrame, flag: str = "player_to_predict") -> DataFrame:
    return df.where(F.col(flag))


def one_play(df: DataFrame, game_id: int, play_id: int) -> DataFrame:
    game, play = PLAY_KEYS
    return df.where((F.col(game) == game_id) & (F.col(play) == play_id))


def null_to_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls become 0.0; NaN is left alone."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def missing_to_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls and NaN become 0.0; infinities are left alone."""
    return df.withColumns(
        {
            c: F.coalesce(S.nan_as_null(F.col(c).cast("double")), F.lit(0.0))
            for c in columns
        }
    )


def not_finite_to_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: S.zero_if_not_finite(F.col(c)) for c in columns})


def scaled_labels(df: DataFrame, x: str = "x_label", y: str = "y_label") -> DataFrame:
    x_scaled, y_scaled = S.scale_labels(F.col(x), F.col(y))
    return df.withColumns({"x_scaled": x_scaled, "y_scaled": y_scaled})


def unscaled_labels(df: DataFrame, x: str = "x_scaled", y: str = "y_scaled") -> DataFrame:
    x_yards, y_yards = S.unscale_labels(F.col(x), F.col(y))
    return df.withColumns({"x_yards": x_yards, "y_yards": y_yards})


def present_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select the listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def composite_key(df: DataFrame, keys: list[str], name: str = "pk") -> DataFrame:
    return df.withColumn(name, F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def error_columns(
    df: DataFrame,
    pred: tuple[str, str] = ("pred_x", "pred_y"),
    truth: tuple[str, str] = ("x", "y"),
) -> DataFrame:
    """Add dx, dy and the Euclidean error."""
    df = df.withColumns({"dx": F.col(pred[0]) - F.col(truth[0]), "dy": F.col(pred[1]) - F.col(truth[1])})
    return df.withColumn("error", S.euclidean(F.col("dx"), F.col("dy")))


@dataclass(frozen=True)
class Scaler:
    """Means and deviations of a few columns; travels as literals, so no join is needed."""

    means: dict[str, float]
    deviations: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns(
            {
                c + suffix: (F.col(c) - F.lit(self.means[c])) / F.lit(self.deviations[c])
                for c in self.means
            }
        )

    def inverse(self, df: DataFrame, renamed: dict[str, str] | None = None) -> DataFrame:
        """Undo the scaling; renamed maps a scaled column to the fitted column."""
        renamed = renamed or {c: c for c in self.means}
        return df.withColumns(
            {
                c: F.col(c) * F.lit(self.deviations[fit]) + F.lit(self.means[fit])
                for c, fit in renamed.items()
            }
        )

    def as_table(self, spark) -> DataFrame:
        rows = [(c, self.means[c], self.deviations[c]) for c in self.means]
        return spark.createDataFrame(rows, "feature string, mean double, deviation double")

    @classmethod
    def from_table(cls, df: DataFrame) -> Scaler:
        rows = df.collect()  # one row per feature column
        return cls({r.feature: r.mean for r in rows}, {r.feature: r.deviation for r in rows})


def column_moments(df: DataFrame, columns: list[str], sample: bool = True) -> DataFrame:
    """One row: mean and deviation of every column; NaN counts as missing."""
    deviation = F.stddev_samp if sample else F.stddev_pop
    out = []
    for c in columns:
        value = S.nan_as_null(F.col(c).cast("double"))
        out += [F.avg(value).alias(f"{c}_mean"), deviation(value).alias(f"{c}_std")]
    return df.agg(*out)


def fit_scaler(
    df: DataFrame, columns: list[str], sample: bool = True, floor: float = 1e-6
) -> Scaler:
    """Mean and deviation of each column in one pass; deviations are floored."""
    row = column_moments(df, columns, sample).first()
    return Scaler(
        {c: row[f"{c}_mean"] if row[f"{c}_mean"] is not None else 0.0 for c in columns},
        {c: max(row[f"{c}_std"] or 0.0, floor) for c in columns},
    )


