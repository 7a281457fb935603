"""Scalar functions on hand-computed values and the null rules."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from gridmotion.functions import scalars as S
from gridmotion.operators import normalize as N


def one(spark, schema, row, **columns):
    return spark.createDataFrame([row], schema).select(
        *[c.alias(n) for n, c in columns.items()]
    ).first()


@pytest.mark.parametrize(
    "text,inches",
    [("6-1", 73.0), ("5-11", 71.0), ("bad", math.nan), ("6", math.nan), ("6-x", math.nan),
     ("6-1-2", math.nan), ("", math.nan), (None, None)],
)
def test_height(spark, text, inches):
    got = one(spark, "h string", (text,), v=S.height_to_inches(F.col("h"))).v
    assert got == inches or (got is not None and math.isnan(got) and math.isnan(inches))


def test_age(spark):
    got = one(spark, "d date", (date(1997, 2, 15),), v=S.age_years(F.col("d"))).v
    assert round(got, 6) == 26.540726
    assert one(spark, "d date", (None,), v=S.age_years(F.col("d"))).v is None


@pytest.mark.parametrize("w,h", [(0, 70.0), (None, 70.0), (200, None), (200, 0.0), (200, -1.0), (200, math.nan)])
def test_bmi_unusable(spark, w, h):
    assert math.isnan(one(spark, "w int, h double", (w, h), v=S.bmi(F.col("w"), F.col("h"))).v)


def test_bmi(spark):
    got = one(spark, "w int, h double", (200, 70.0), v=S.bmi(F.col("w"), F.col("h"))).v
    assert got == 200 * 703 / 4900


def test_wrap_is_floored(spark):
    for angle, want in ((-190.5, 169.5), (359.0, 359.0), (360.0, 0.0), (725.0, 5.0)):
        assert one(spark, "a double", (angle,), v=S.wrap_degrees(F.col("a"))).v == want


def test_ball_position(spark):
    schema = "x0 double, y0 double, x1 double, y1 double, f int, n int"

    def at(*row):
        bx, by = S.ball_position(*[F.col(c) for c in ("x0", "y0", "x1", "y1", "f", "n")])
        r = one(spark, schema, row, bx=bx, by=by)
        return r.bx, r.by

    assert at(0.0, 0.0, 10.0, 20.0, 5, 10) == (5.0, 10.0)
    assert at(0.0, 0.0, 10.0, 20.0, 15, 10) == (10.0, 20.0)
    assert at(0.0, 0.0, 10.0, 20.0, -3, 10) == (0.0, 0.0)
    assert all(math.isnan(v) for v in at(0.0, 0.0, 10.0, 20.0, 5, 0))
    assert all(math.isnan(v) for v in at(None, 0.0, 10.0, 20.0, 5, 10))


def test_distance_and_bearing(spark):
    d, b = S.distance_and_bearing(*[F.col(c) for c in "abcd"])
    r = one(spark, "a double, b double, c double, d double", (0.0, 0.0, 3.0, 4.0), d=d, b=b)
    assert (r.d, r.b) == (5.0, math.atan2(4, 3))
    r = one(spark, "a double, b double, c double, d double", (None, 0.0, 3.0, 4.0), d=d, b=b)
    assert math.isnan(r.d) and math.isnan(r.b)


ROW = "x double, y double, dir double, o double, play_direction string"


def norm(spark, row, wrap=False):
    return tuple(
        N.rightward(spark.createDataFrame([row], ROW), wrap=wrap).select(*N.NORM_COLUMNS).first()
    )


def test_mirror(spark):
    got = norm(spark, (20.0, 10.0, 181.0, 359.0, "LEFT"))
    assert got == (100.0, 160.0 / 3.0 - 10.0, 1.0, 179.0)
    assert norm(spark, (20.0, 10.0, 400.0, 5.0, "right")) == (20.0, 10.0, 400.0, 5.0)
    assert norm(spark, (20.0, 10.0, 400.0, 5.0, "right"), wrap=True) == (20.0, 10.0, 40.0, 5.0)
    assert norm(spark, (20.0, 10.0, 400.0, 5.0, None)) == (20.0, 10.0, 400.0, 5.0)
    assert norm(spark, (None, 10.0, None, 5.0, "left"))[0] is None
    scalar = norm(spark, (None, 10.0, None, 5.0, "left"), wrap=True)
    assert math.isnan(scalar[0]) and math.isnan(scalar[2])


def test_mirror_twice_is_identity(spark):
    once = N.rightward(spark.createDataFrame([(20.0, 10.0, 33.0, 44.0, "left")], ROW))
    again = once.select(
        *[F.col(c).alias(c.removesuffix("_norm")) for c in N.NORM_COLUMNS], "play_direction"
    )
    assert tuple(N.rightward(again).select(*N.NORM_COLUMNS).first()) == (20.0, 10.0, 33.0, 44.0)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="dir, play_direction"):
        N.rightward(spark.createDataFrame([(1.0, 1.0, 1.0)], "x double, y double, o double"))


def test_fills(spark):
    df = spark.createDataFrame([(None,), (math.nan,), (math.inf,), (2.0,)], "v double")
    as_list = lambda d: [r.v for r in d.collect()]
    nulls = as_list(N.null_to_zero(df, ["v"]))
    assert nulls[0] == 0.0 and math.isnan(nulls[1])
    assert as_list(N.missing_to_zero(df, ["v"])) == [0.0, 0.0, math.inf, 2.0]
    assert as_list(N.not_finite_to_zero(df, ["v"])) == [0.0, 0.0, 0.0, 2.0]


def test_scaler_floors_constant_columns(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 3.0)], "c double, d double")
    scaler = N.fit_scaler(df, ["c", "d"])
    assert scaler.deviations["c"] == 1e-6 and scaler.means == {"c": 3.0, "d": 2.0}
    rows = scaler.inverse(scaler.transform(df)).collect()
    assert [(round(r.c, 9), round(r.d, 9)) for r in rows] == [(3.0, 1.0), (3.0, 3.0)]
    assert N.Scaler.from_table(scaler.as_table(spark)) == scaler


def test_velocity_conventions(spark):
    math_v = S.heading_components(F.col("s"), F.col("d"))
    compass = S.heading_components(F.col("s"), F.col("d"), "compass")
    r = one(spark, "s double, d double", (2.0, 90.0), a=math_v[0], b=math_v[1], c=compass[0], d=compass[1])
    assert [round(v, 9) for v in r] == [0.0, 2.0, 2.0, 0.0]
    with pytest.raises(ValueError):
        S.heading_components(F.col("s"), F.col("d"), "grid")
