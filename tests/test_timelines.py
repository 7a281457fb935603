"""Time features: null rules, and long timelines cut into segments."""

import math
import random
import statistics

import pytest

from gridmotion.operators.skew import dense_index, edge_frame_rows, latest_rows, split_large_groups
from gridmotion.operators.temporal import prior_features, temporal_features

SCHEMA = (
    "game_id long, play_id long, nfl_id long, frame_id int, s double, a double, dir double, "
    "x double, y double"
)


def timeline(pid, values, start=1):
    return [
        (1, 1, pid, start + i, s, a, d, x, y) for i, (s, a, d, x, y) in enumerate(values)
    ]


def random_rows(seed, lengths, gaps=False):
    rng, rows = random.Random(seed), []
    for pid, n in enumerate(lengths):
        frame = 0
        for _ in range(n):
            frame += rng.choice([1, 1, 7, 40]) if gaps else 1
            value = lambda: None if rng.random() < 0.1 else rng.uniform(0, 9)
            rows.append((1, 1, pid, frame, value(), value(), rng.uniform(0, 360), value(), value()))
    return rows


def brute(rows):
    out = {}
    by_player = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        by_player.setdefault(r[2], []).append(r)
    for pid, line in by_player.items():
        total = 0.0
        for i, r in enumerate(line):
            row = {}
            for label, at in (("speed", 4), ("accel", 5)):
                for w in (3, 5):
                    vals = [q[at] for q in line[max(0, i - w + 1) : i + 1]]
                    full = len(vals) == w and None not in vals
                    row[f"{label}_rolling_mean_{w}"] = sum(vals) / w if full else None
                    row[f"{label}_rolling_std_{w}"] = statistics.stdev(vals) if full else None
            prev = line[i - 1] if i else None

            def diff(at):
                if prev is None or prev[at] is None or r[at] is None:
                    return None
                return r[at] - prev[at]

            row["angular_velocity"] = None if prev is None else (diff(6) + 180.0) % 360.0 - 180.0
            row["delta_x"], row["delta_y"] = diff(7), diff(8)
            if row["delta_x"] is None or row["delta_y"] is None:
                row["cumulative_distance"] = None
            else:
                total += math.hypot(row["delta_x"], row["delta_y"])
                row["cumulative_distance"] = total
            out[(pid, r[3])] = row
    return out


@pytest.mark.parametrize("max_rows", [100_000, 7, 2])
@pytest.mark.parametrize("gaps", [False, True])
def test_temporal_features_equal_brute_force(spark, max_rows, gaps):
    rows = random_rows(3, [1, 4, 25, 60], gaps)
    df = spark.createDataFrame(rows, SCHEMA)
    out = temporal_features(df, max_rows=max_rows).collect()
    want = brute(rows)
    assert len(out) == len(rows)
    for r in out:
        for name, value in want[(r.nfl_id, r.frame_id)].items():
            got = r[name]
            assert (got is None) == (value is None), (r, name, value)
            assert value is None or abs(got - value) < 1e-9, (r, name, value)


def test_rolling_needs_a_full_window_of_values(spark):
    values = [(1.0, 1.0, 350.0, 0.0, 0.0), (2.0, 2.0, 10.0, 3.0, 4.0), (None, 3.0, 20.0, None, 4.0)]
    values += [(4.0, 4.0, 200.0, 6.0, 8.0), (5.0, 5.0, 20.0, 6.0, 9.0)]
    out = temporal_features(spark.createDataFrame(timeline(7, values), SCHEMA)).orderBy("frame_id")
    rows = out.collect()
    assert [r.speed_rolling_mean_3 for r in rows] == [None] * 5
    assert rows[2].accel_rolling_mean_3 == 2.0
    assert [r.angular_velocity for r in rows] == [None, 20.0, 10.0, -180.0, -180.0]
    assert [r.cumulative_distance for r in rows] == [None, 5.0, None, None, 6.0]


@pytest.mark.parametrize("max_rows", [100_000, 5])
def test_prior_features_drop_rows_without_history(spark, max_rows):
    rows = [(1, 1, 1, f, 0.0, 0.0, 0.0, float(f), float(-f)) for f in range(1, 21)]
    rows += [(1, 1, 2, f, 0.0, 0.0, 0.0, float(f), None) for f in range(1, 6)]
    out = prior_features(spark.createDataFrame(rows, SCHEMA), 3, max_rows=max_rows).collect()
    assert sorted(r.frame_id for r in out) == list(range(4, 21))
    assert all(r.x_prior3 == r.frame_id - 3 and r.y_prior1 == 1 - r.frame_id for r in out)


def test_split_large_groups_is_complete_and_disjoint(spark):
    df = spark.range(100).selectExpr("CASE WHEN id < 70 THEN 0 ELSE id END AS k", "id")
    small, large = split_large_groups(df, ["k"], 10)
    assert large.count() == 70 and small.count() == 30
    assert split_large_groups(df, ["k"], 70)[1] is None


def test_dense_index_is_ordered_without_gaps(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS a", "id % 3 AS b").repartition(7)
    out = dense_index(df, ["a", "b"]).collect()
    assert sorted(r.idx for r in out) == list(range(1000))
    assert all(r.idx == r.a for r in out)


def test_latest_and_edge_rows(spark):
    rows = [(1, 1, 1, f, 0.0, 0.0, 0.0, float(f), 0.0) for f in (3, 1, 2)]
    rows += [(1, 1, None, 9, 0.0, 0.0, 0.0, 9.0, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    keys = ["game_id", "play_id", "nfl_id"]
    assert {r.frame_id for r in latest_rows(df, keys, ["frame_id"], 2).collect()} == {2, 3, 9}
    assert [r.frame_id for r in edge_frame_rows(df, keys, "frame_id", "first").collect()] == [1]
    with pytest.raises(ValueError):
        edge_frame_rows(df, keys, "frame_id", "middle")


@pytest.mark.parametrize("which", ["first", "last"])
@pytest.mark.parametrize("ticks", [1, 3])
def test_edge_frames_agree_between_routes(spark, which, ticks):
    rows = [(1, 1, p, f, 0.0, 0.0, 0.0, float(i), 0.0) for p in (1, 2) for f in (1, 2, 5, 6) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    keys = ["game_id", "play_id", "nfl_id"]

    def result(crowd):
        out = edge_frame_rows(df, keys, "frame_id", which, ticks, crowd).collect()
        return sorted((r.nfl_id, r.frame_id, r.x) for r in out)

    kept = {("first", 1): {1}, ("last", 1): {6}, ("first", 3): {1, 2}, ("last", 3): {5, 6}}
    assert result(10**6) == result(3)
    assert {f for _, f, _ in result(3)} == kept[(which, ticks)]
