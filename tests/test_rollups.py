"""Aggregations, joins, sequences and samples on small frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridmotion.operators import joins, quality, rollups, sampling, sequences
from gridmotion.operators.evaluate import padded_rmse, play_averaged_rmse, rmse

K4 = "game_id long, play_id long, nfl_id long, frame_id int"


@pytest.mark.parametrize("buckets", [256, 3, 1])
def test_exact_quantile_is_nearest_rank(spark, buckets):
    rng = random.Random(5)
    data = {1: [rng.choice([0.0, 0.5, 1.0]) for _ in range(50)], 2: [7.0], 3: [rng.uniform(-5, 5) for _ in range(33)]}
    rows = [(k, v) for k, vs in data.items() for v in vs] + [(1, None), (4, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    for q in (0.0, 0.5, 0.9, 1.0):
        got = {r.k: r.q for r in rollups.exact_quantile(df, ["k"], "v", q, "q", buckets).collect()}
        want = {k: sorted(vs)[math.floor(q * (len(vs) - 1) + 0.5)] for k, vs in data.items()}
        assert got == want


def test_last_known_position_is_per_column(spark):
    rows = [(1, 1, 1, 1, 5.0, 1.0), (1, 1, 1, 2, 6.0, None), (1, 1, 1, 3, None, math.nan)]
    out = rollups.last_known_position(spark.createDataFrame(rows, K4 + ", x double, y double"))
    assert tuple(out.first())[3:] == (6.0, 1.0)


def test_last_k_frames_counts_ticks_not_rows(spark):
    rows = [(1, 1, "Offense", f) for f in (1, 4, 9, 10, 10)] + [(1, 1, None, 10)]
    df = spark.createDataFrame(rows, "game_id long, play_id long, player_side string, frame_id int")
    assert sorted(r.frame_id for r in rollups.last_k_frames(df, 2).collect()) == [9, 10, 10]
    assert sorted(r.frame_id for r in rollups.last_k_frames(df, 7).collect()) == [4, 9, 10, 10]


def test_pivot_with_one_side_only(spark):
    df = spark.createDataFrame(
        [(1, 1, "Offense", 2.0), (1, 2, "Defense", 3.0), (1, 2, "Offense", 4.0)],
        "game_id long, play_id long, player_side string, v double",
    )
    out = {r.play_id: (r.v_Offense, r.v_Defense) for r in rollups.pivot_sides(df, ["v"]).collect()}
    assert out == {1: (2.0, None), 2: (4.0, 3.0)}


def test_pooling(spark):
    rows = [("a", [1.0, 5.0], True), ("a", [3.0, -1.0], True), ("a", [9.0, 9.0], False), ("b", [1.0, 1.0], False)]
    df = spark.createDataFrame(rows, "k string, v array<double>, keep boolean")

    def pooled(how):
        return {r.k: r.v for r in rollups.pool_vectors(df, ["k"], "v", 2, how, "keep").collect()}

    assert pooled("mean") == {"a": [2.0, 2.0], "b": [0.0, 0.0]}
    assert pooled("sum") == {"a": [4.0, 4.0], "b": [0.0, 0.0]}
    assert pooled("max") == {"a": [3.0, 5.0], "b": [-1e9, -1e9]}


def _series(n, pid=1, missing=()):
    return [(1, 1, pid, f, None if f in missing else float(f), float(f) * 10) for f in range(n, 0, -1)]


SEQ = K4 + ", x double, y double"


@pytest.mark.parametrize("n", [2, 4, 6])
def test_pack_shorter_equal_longer(spark, n):
    df = spark.createDataFrame(_series(n), SEQ)
    first = sequences.pack_sequences(df, {"f": ["x", "y"]}, 4).first()
    last = sequences.pack_sequences(df, {"f": ["x"]}, 4, keep="last", pad="left").first()
    real = [[float(f), f * 10.0] for f in range(1, min(n, 4) + 1)]
    assert first.f == real + [[0.0, 0.0]] * (4 - len(real))
    tail = [[float(f)] for f in range(max(1, n - 3), n + 1)]
    assert last.f == [[0.0]] * (4 - len(tail)) + tail
    skipped = sequences.pack_sequences(df, {"f": ["x"]}, 4, keep="last", pad=None).collect()
    assert len(skipped) == (0 if n < 4 else 1)
    assert first.n_steps == min(n, 4)


def test_play_sequences_skip_unusable_targets(spark):
    rows = _series(3, 1) + _series(3, 2) + _series(2, 3, missing=(2,))
    df = spark.createDataFrame(rows, SEQ).withColumn(
        "t", F.when(F.col("nfl_id") == 2, F.lit(math.nan)).otherwise(F.lit(1.5))
    )
    out = {r.nfl_id: r for r in sequences.play_sequences(df, ["x"], ["t"], 3).collect()}
    assert set(out) == {1, 3} and out[3].features == [[0.0], [1.0], [0.0]]
    assert out[1].target == [1.5]


def test_unpack_restores_rows(spark):
    df = spark.createDataFrame(_series(5), SEQ).withColumnsRenamed({"x": "x_norm", "y": "y_norm"})
    packed = sequences.frame_sequences(df, ["x_norm", "y_norm"], 3)
    out = sequences.unpack_sequences(packed, values="targets").orderBy("frame_id").collect()
    assert [(r.frame_id, r.pred_x, r.pred_y) for r in out] == [(f, float(f), f * 10.0) for f in (3, 4, 5)]


def test_formation_vector_truncates_and_counts(spark):
    rows = [(1, 1, "Offense", 1, i, float(i), float(-i)) for i in range(12)]
    rows += [(1, 1, "Offense", 2, 1, 0.0, 0.0), (1, 1, "Defense", 5, 1, 2.0, 3.0)]
    df = spark.createDataFrame(
        rows, "game_id long, play_id long, player_side string, frame_id int, nfl_id long, x_norm double, y_norm double"
    )
    out = {r.player_side: r for r in sequences.formation_vectors(df, None).collect()}
    assert out["Offense"].n_players == 12 and out["Offense"].frame_id == 1
    assert out["Offense"].vector[:4] == [11.0, -11.0, 10.0, -10.0] and len(out["Offense"].vector) == 22
    assert out["Defense"].vector == [2.0, 3.0] + [0.0] * 20


def test_split_is_complete_disjoint_and_by_key(spark):
    df = spark.range(2000).selectExpr("id DIV 20 AS game_id", "id % 20 AS play_id", "id")
    df = df.unionByName(df)
    out = sampling.train_val_test(df)
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert sum(counts.values()) == 4000 and abs(counts["train"] / 4000 - 0.7) < 0.05
    assert out.select("game_id", "play_id", "split").distinct().count() == 2000
    with pytest.raises(ValueError):
        sampling.train_val_test(df, 0.5, 0.1, 0.1)


def test_sampled_sequences_are_whole(spark):
    rows = [r for pid in range(20) for r in _series(4, pid)]
    df = spark.createDataFrame(rows, SEQ)
    out = sampling.sample_sequences(df, 5)
    assert out.count() == 20 and out.select("nfl_id").distinct().count() == 5
    again = sampling.sample_sequences(df.repartition(5), 5)
    assert {r.nfl_id for r in out.collect()} == {r.nfl_id for r in again.collect()}


def test_player_lookup_modes(spark):
    df = spark.createDataFrame([(1,), (2,)], "nfl_id long")
    index = spark.createDataFrame([(2, 5)], "nfl_id long, player_idx long")
    assert [tuple(r) for r in joins.with_player_index(df, index).collect()] == [(2, 5)]
    zero = joins.with_player_index(df, index, "zero").collect()
    assert {tuple(r) for r in zero} == {(1, 0), (2, 5)}


def test_rmse_modes(spark):
    rows = [(1, 1, 1, 1, 3.0, 4.0, 0.0, 0.0), (1, 2, 1, 1, 0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, K4 + ", x_pred double, y_pred double, x_true double, y_true double")
    value = lambda mode: rmse(df, mode).first().rmse
    assert value("mean_sq2d") == math.sqrt(12.5)
    assert value("half") == value("elementwise") == math.sqrt(6.25)
    assert value("elementwise_half") == math.sqrt(12.5) / 2
    assert play_averaged_rmse(df).first().rmse == 2.5
    keys = ["game_id", "play_id", "nfl_id"]
    assert padded_rmse(df, keys, 5).first().rmse == math.sqrt(25 / 20)
    with pytest.raises(ValueError):
        rmse(df, "other")


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, None), (3, math.inf)], "k int, v double")
    with pytest.raises(ValueError, match="2 duplicate rows"):
        quality.assert_unique(df, ["k"], "t")
    quality.assert_unique(df.where("k > 1"), ["k"], "t")
    row = quality.numeric_profile(df, ["v"]).first()
    assert (row.n_nulls, row.has_inf, row.min) == (1, True, 1.0)
    spread = spark.createDataFrame([(0.0,)] * 99 + [(100.0,)], "v double")
    assert quality.numeric_profile(spread, ["v"]).first().beyond_sigmas
    weeks = lambda *w: spark.createDataFrame([(i,) for i in w], "week int")
    quality.assert_same_weeks(weeks(1, 2), weeks(2, 1))
    with pytest.raises(ValueError, match="'input': \\[3\\], 'output': \\[1\\]"):
        quality.assert_same_weeks(weeks(1, 2), weeks(2, 3))
    with pytest.raises(ValueError):
        quality.assert_not_empty(df.where("k > 9"), "t")
