"""Coverage and shape against brute force, on ordinary and crowded frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridmotion.operators import spatial
from gridmotion.operators.rollups import formation_targets

SCHEMA = (
    "game_id long, play_id long, frame_id int, player_side string, nfl_id long, "
    "x double, y double"
)


def make_rows(seed=1, players=14):
    rng = random.Random(seed)
    rows = []
    for frame in range(1, 4):
        for pid in range(players):
            side = rng.choice(["Offense", "Defense"])
            rows.append((1, 1, frame, side, pid, rng.uniform(0, 20), rng.uniform(0, 20)))
    rows.append((1, 1, 1, None, 90, 3.0, 3.0))
    rows.append((1, 1, 1, "Offense", None, 4.0, 4.0))
    rows.append((1, 1, 2, "Defense", 91, None, 4.0))
    rows.append((1, 1, 2, "Defense", 92, float("nan"), 4.0))
    rows.append((2, 1, 1, "Offense", 5, 1.0, 1.0))  # alone in its frame
    rows.append((2, 2, 1, "Offense", 5, 0.0, 0.0))  # teammate only, distance exactly 3
    rows.append((2, 2, 1, "Offense", 6, 3.0, 0.0))
    rows.append((2, None, 1, "Offense", 7, 3.0, 0.0))
    rows.append((2, None, 1, "Defense", 8, 3.0, 0.0))
    return rows


def brute(rows, radii):
    out = {}
    for g, p, f, s, i, x, y in rows:
        pairs = []
        for g2, p2, f2, s2, i2, x2, y2 in rows:
            if None in (g, p, f, i, g2, p2, f2, i2) or (g, p, f) != (g2, p2, f2) or i == i2:
                continue
            d = None if None in (x, y, x2, y2) else math.sqrt((x - x2) ** 2 + (y - y2) ** 2)
            pairs.append((None if None in (s, s2) else s == s2, d))
        opp = [d for same, d in pairs if same is False]
        tm = [d for same, d in pairs if same is True]

        def least(ds):
            ds = [d for d in ds if d is not None]
            real = [d for d in ds if not math.isnan(d)]
            return min(real) if real else (float("nan") if ds else None)

        row = {
            "distance_to_nearest_teammate": least(tm),
            "distance_to_nearest_opponent": least(opp),
            "coverage_density": sum(1 / (1 + d) for d in opp if d is not None) if pairs else None,
        }
        for r in radii:
            for label, ds in (("opponents", opp), ("teammates", tm)):
                row[f"{label}_within_{int(r)}yds"] = (
                    sum(d is not None and d < r for d in ds) if ds else None
                )
        out[(g, p, f, s, i)] = row
    return out


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return abs(a - b) < 1e-9


@pytest.mark.parametrize("max_members", [256, 5])
def test_coverage_equals_brute_force(spark, max_members):
    radii = (3.0, 5.0, 7.0)
    rows = make_rows()
    out = spatial.coverage_features(
        spark.createDataFrame(rows, SCHEMA), radii, max_members=max_members
    ).collect()
    expected = brute(rows, radii)
    assert len(out) == len(rows)
    for r in out:
        want = expected[(r.game_id, r.play_id, r.frame_id, r.player_side, r.nfl_id)]
        for name, value in want.items():
            assert same(r[name], value), (r, name, value)


def test_shape_and_coverage_agrees_between_routes(spark):
    df = spark.createDataFrame(make_rows(), SCHEMA)
    args = ((3.0,), ["game_id", "play_id", "frame_id"], "player_side", "nfl_id", "x", "y")
    key = lambda r: tuple(str(v) for v in r[:5])
    whole = sorted(spatial.shape_and_coverage(df, *args).collect(), key=key)
    cut = sorted(spatial.shape_and_coverage(df, *args, max_members=4).collect(), key=key)
    assert len(whole) == len(cut)
    for a, b in zip(whole, cut):
        for name in a.asDict():
            if isinstance(a[name], float) or a[name] is None:
                assert same(a[name], b[name]), (name, a, b)
            else:
                assert a[name] == b[name]


@pytest.mark.parametrize("max_members", [256, 5])
def test_formation_features(spark, max_members):
    df = spark.createDataFrame(make_rows(), SCHEMA)
    out = spatial.formation_features(df, max_members=max_members)
    row = out.where("game_id = 2 and play_id = 2 and nfl_id = 6").first()
    assert (row.formation_width, row.formation_depth, row.formation_x_mean) == (0.0, 3.0, 1.5)
    assert row.distance_to_formation_center == 1.5
    assert out.where("player_side is null").first().formation_width is None
    assert out.count() == df.count()


@pytest.mark.parametrize("max_members", [256, 5])
def test_neighbours_are_symmetric_and_complete(spark, max_members):
    df = spark.createDataFrame(make_rows(), SCHEMA)
    pairs = spatial.frame_neighbours(df, max_members=max_members).select(
        "game_id", "play_id", "frame_id", "nfl_id", F.explode("neighbours").alias("n")
    )
    seen = {(*r[:4], r.n.pid) for r in pairs.collect()}
    assert seen == {(g, p, f, b, a) for g, p, f, a, b in seen}
    assert len([s for s in seen if s[2] == 3 and s[0] == 1]) == 14 * 13


def test_team_and_opponent_means(spark):
    rows = [
        (1, 1, 1, "Offense", 1, 0.0, 0.0),
        (1, 1, 1, "Offense", 2, 4.0, 2.0),
        (1, 1, 1, "Defense", 3, 10.0, 8.0),
        (1, 1, 1, "Defense", 4, None, 8.0),
        (1, 2, 1, "Defense", 4, 1.0, 8.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {
        (r.play_id, r.nfl_id): (r.team_avg_x, r.team_avg_y, r.opp_avg_x, r.opp_avg_y)
        for r in spatial.team_opponent_means(df, x="x", y="y").collect()
    }
    assert out[(1, 1)] == (2.0, 1.0, 10.0, 8.0)
    assert out[(1, 4)] == (10.0, 8.0, 2.0, 1.0)
    assert out[(2, 4)][:2] == (1.0, 8.0) and math.isnan(out[(2, 4)][2])


def test_play_state_score(spark):
    schema = SCHEMA + ", player_role string, ball_land_x double, ball_land_y double"
    rows = [
        (1, 1, 1, "Offense", 1, 0.0, 0.0, "Targeted Receiver", 3.0, 4.0),
        (1, 1, 1, "Offense", 2, 3.0, 4.0, "Other", 3.0, 4.0),
        (1, 1, 1, "Defense", 3, 1.0, 0.0, "Other", 3.0, 4.0),
        (1, 1, 1, "Defense", 4, 2.0, 0.0, "Other", 3.0, 4.0),
    ]
    score = spatial.play_state_score(spark.createDataFrame(rows, schema)).first().score
    assert score == -50 * 5.0 - 100


def test_formation_targets_skip_unusable_positions(spark):
    rows = [
        (1, 1, 1, "Offense", 1, 0.0, 0.0),
        (1, 1, 1, "Offense", 2, 6.0, 8.0),
        (1, 1, 1, "Offense", 3, float("nan"), 1.0),
        (1, 1, 1, "Offense", 4, float("inf"), 1.0),
        (1, 2, 1, "Offense", 4, None, 1.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    keys = ["game_id", "play_id", "frame_id", "player_side"]
    out = {r.play_id: r for r in formation_targets(df, keys, "x", "y").collect()}
    assert tuple(out[1])[4:] == (6.0, 8.0, 3.0, 4.0, 5.0)
    assert tuple(out[2])[4:] == (0.0,) * 5
