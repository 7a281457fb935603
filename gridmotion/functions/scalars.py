"""Scalar functions over tracking columns.

Nulls stay null unless a function says otherwise; NaN marks a value that is present
but unusable. All of them compile to built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmotion.schemas import (
    AGE_REFERENCE_DATE,
    FIELD_LENGTH,
    FIELD_WIDTH,
    LABEL_SCALE_X,
    LABEL_SCALE_Y,
)

NAN = float("nan")

# Days per year in ages, and the pounds-and-inches factor of the body mass index.
DAYS_PER_YEAR = 365.25
BMI_FACTOR = 703.0


def _nan() -> Column:
    return F.lit(NAN)


def any_null(*cols: Column) -> Column:
    out = F.lit(False)
    for col in cols:
        out = out | col.isNull()
    return out


def height_to_inches(height: Column) -> Column:
    """Feet-inches text in inches, 73.0 for '6-1'; text of any other form is NaN."""
    parts = F.split(height, "-", -1)
    inches = F.get(parts, 0).try_cast("bigint") * 12 + F.get(parts, 1).try_cast("bigint")
    parsed = F.when(F.size(parts) == 2, inches.cast("double"))
    return F.when(height.isNotNull(), F.coalesce(parsed, _nan()))


def age_years(birth_date: Column, ref: str = AGE_REFERENCE_DATE) -> Column:
    return F.datediff(F.lit(ref).cast("date"), birth_date) / F.lit(DAYS_PER_YEAR)


def bmi(weight_lb: Column, height_in: Column) -> Column:
    """NaN when weight is missing or zero, or height is missing or not positive."""
    unusable = any_null(weight_lb, height_in) | (weight_lb == 0) | (height_in <= 0)
    return F.when(unusable, _nan()).otherwise(
        weight_lb.cast("double") * BMI_FACTOR / (height_in * height_in)
    )


def deg_to_rad(deg: Column) -> Column:
    return F.radians(deg)


def wrap_degrees(deg: Column) -> Column:
    """Wrap into [0, 360)."""
    return F.pmod(deg, F.lit(360.0))


def sin_deg(deg: Column) -> Column:
    return F.sin(F.radians(deg))


def cos_deg(deg: Column) -> Column:
    return F.cos(F.radians(deg))


def heading_components(
    magnitude: Column, dir_deg: Column, convention: str = "math"
) -> tuple[Column, Column]:
    """Split a speed or acceleration along x and y.

    'math' measures the heading from the x axis, 'compass' from the y axis.
    """
    along_cos, along_sin = magnitude * cos_deg(dir_deg), magnitude * sin_deg(dir_deg)
    if convention == "math":
        return along_cos, along_sin
    if convention == "compass":
        return along_sin, along_cos
    raise ValueError(f"unknown convention {convention!r}")


def ball_position(
    x0: Column, y0: Column, x_land: Column, y_land: Column, rel_frame: Column, n_frames: Column
) -> tuple[Column, Column]:
    """Straight-line ball position, clamped to the flight; NaN when it is undefined."""
    undefined = any_null(x0, y0, x_land, y_land, rel_frame, n_frames) | (n_frames <= 0)
    share = rel_frame.cast("double") / n_frames.cast("double")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    return (
        F.when(undefined, _nan()).otherwise(x0 + t * (x_land - x0)),
        F.when(undefined, _nan()).otherwise(y0 + t * (y_land - y0)),
    )


def euclidean(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def distance_and_bearing(x: Column, y: Column, tx: Column, ty: Column) -> tuple[Column, Column]:
    """Distance and bearing (radians) towards a point; NaN when any input is missing."""
    missing = any_null(x, y, tx, ty)
    return (
        F.when(missing, _nan()).otherwise(F.hypot(tx - x, ty - y)),
        F.when(missing, _nan()).otherwise(F.atan2(ty - y, tx - x)),
    )


def moves_left(play_direction: Column) -> Column:
    return F.coalesce(F.lower(play_direction) == "left", F.lit(False))


def mirror_length(value: Column, left: Column, size: float) -> Column:
    return F.when(left, F.lit(size) - value).otherwise(value).cast("double")


def mirror_angle(deg: Column, left: Column, wrap: bool = False) -> Column:
    """Turn by 180 degrees when moving left; wrap=True also wraps the other rows."""
    return F.when(left, wrap_degrees(deg + 180.0)).otherwise(wrap_degrees(deg) if wrap else deg)


def normalize_rightward(
    x: Column,
    y: Column,
    dir_deg: Column,
    o_deg: Column,
    play_direction: Column,
    field_length: float = FIELD_LENGTH,
    field_width: float = FIELD_WIDTH,
) -> tuple[Column, Column, Column, Column]:
    """Mirror so the offence moves right, wrapping all angles; missing angles become NaN."""
    left = moves_left(play_direction)
    nan_if_left = F.when(left, _nan())
    return (
        F.coalesce(mirror_length(x, left, field_length), nan_if_left),
        F.coalesce(mirror_length(y, left, field_width), nan_if_left),
        F.coalesce(mirror_angle(dir_deg, left, wrap=True), _nan()),
        F.coalesce(mirror_angle(o_deg, left, wrap=True), _nan()),
    )


def scale_labels(x: Column, y: Column) -> tuple[Column, Column]:
    return x / LABEL_SCALE_X, y / LABEL_SCALE_Y


def unscale_labels(x: Column, y: Column) -> tuple[Column, Column]:
    return x * LABEL_SCALE_X, y * LABEL_SCALE_Y


def is_finite(col: Column) -> Column:
    """False for null, NaN and both infinities."""
    value = col.cast("double")
    return F.coalesce(~F.isnan(value) & (F.abs(value) != float("inf")), F.lit(False))


def zero_if_not_finite(col: Column) -> Column:
    return F.when(is_finite(col), col.cast("double")).otherwise(F.lit(0.0))


def nan_as_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def key_digest(keys: list[str], seed: int) -> Column:
    """md5 of seed and keys: the same in every engine and independent of partitioning."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("#", F.lit(str(seed)), *parts))


def key_number(keys: list[str], seed: int) -> Column:
    """Digest as an integer in [0, 2^32)."""
    return F.conv(F.substring(key_digest(keys, seed), 1, 8), 16, 10).cast("bigint")


def key_fraction(keys: list[str], seed: int) -> Column:
    """Digest as a fraction in [0, 1)."""
    return key_number(keys, seed) / F.lit(float(2**32))
