"""Model runs end to end with few trees."""

import math

import pytest
from pyspark.sql import functions as F

from gridmotion.catalog.base import labels, tracking
from gridmotion.operators import models
from gridmotion.operators.normalize import fit_scaler
from gridmotion.plans import jobs
from gridmotion.plans import tables as P
from gridmotion.schemas import ROW_KEYS, T0_FEATURES

SF = "/root/testdata/sf0.01"
FEW = {"trees": 2, "depth": 2}


def test_lag_model_run(spark, tmp_path):
    rows = tracking(spark, SF).select(*ROW_KEYS, F.col("x").alias("x_y"), F.col("y").alias("y_y"), "s", "a")
    rows.write.option("header", True).csv(f"{tmp_path}/combined.csv")
    error, scored = jobs.lag_model_error(
        spark, f"{tmp_path}/combined.csv", 3, f"{tmp_path}/metrics", FEW
    )
    stored = spark.read.parquet(f"{tmp_path}/metrics").first()
    assert stored.metric == "lag_model_rmse" and stored.value == pytest.approx(error)
    assert 0 < error < 100 and scored.count() > 0


def test_t0_and_kinematic_runs(spark, tmp_path):
    overall, by_play = jobs.t0_model_error(tracking(spark, SF), labels(spark, SF), FEW)
    assert 0 < overall < 100 and 0 < by_play < 100
    error, matched = jobs.kinematic_error(tracking(spark, SF), labels(spark, SF), f"{tmp_path}/p.csv")
    # Rows without a speed have no projection; they do not count.
    known = matched.where("x_pred IS NOT NULL")
    want = known.agg(
        F.sqrt(F.avg((F.col("x_pred") - F.col("x_true")) ** 2 + (F.col("y_pred") - F.col("y_true")) ** 2) / 2)
    ).first()[0]
    assert error == pytest.approx(want)


def test_bundle_round_trip(spark, tmp_path):
    rows = P.t0_training_table(tracking(spark, SF), labels(spark, SF))
    fitted = models.fit_axes(rows, T0_FEATURES, settings=FEW)
    scaler = fit_scaler(rows, ["x", "y"])
    models.save_bundle(fitted, P.player_index(tracking(spark, SF)), scaler, str(tmp_path))
    loaded, index, stats = models.load_bundle(spark, str(tmp_path))
    assert stats == scaler and index.count() > 0
    first = models.score(fitted, rows, T0_FEATURES, ROW_KEYS).orderBy(*ROW_KEYS).collect()
    again = models.score(loaded, rows, T0_FEATURES, ROW_KEYS).orderBy(*ROW_KEYS).collect()
    assert first == again and len(first) == rows.count()


def test_search_keeps_the_best(spark):
    rows = P.t0_training_table(tracking(spark, SF), labels(spark, SF))
    space = models.SearchSpace(depth=(1, 2), trees=(1, 2))
    found = models.search_settings(rows, T0_FEATURES, trials=3, k=None, space=space, n_sequences=60)
    errors = [error for _, error in found.trials]
    assert found.score == min(errors) and len(errors) == 3
    table = found.history_table(spark).orderBy("trial").collect()
    assert [r.error for r in table] == errors and [r.trial for r in table] == [1, 2, 3]


def test_search_moves_every_setting(spark):
    import random

    space, rng = models.SearchSpace(), random.Random(1)
    place, seen = space.anywhere(rng), {name: set() for name in vars(space)}
    for _ in range(300):
        place = space.beside(place, rng)
        for name, at in place.items():
            seen[name].add(getattr(space, name)[at])
    assert all(seen[name] == set(values) for name, values in vars(space).items())


def test_search_needs_rows_to_score(spark):
    rows = P.t0_training_table(tracking(spark, SF), labels(spark, SF)).where("game_id = 0")
    with pytest.raises(ValueError):
        models.cross_validated_error(rows, T0_FEATURES, settings=FEW)


def test_loaded_models_know_their_features(spark, tmp_path):
    rows = P.t0_training_table(tracking(spark, SF), labels(spark, SF))
    models.fit_axes(rows, T0_FEATURES, settings=FEW).save(str(tmp_path))
    assert models.AxisModels.load(str(tmp_path)).features == list(T0_FEATURES)


def test_projection_frames_and_motion(spark):
    row = (1, 1, 7, 4, True, 3, 10.0, 20.0, 2.0, 1.0, 90.0)
    schema = (
        "game_id long, play_id long, nfl_id long, frame_id int, player_to_predict boolean, "
        "num_frames_output int, x double, y double, s double, a double, dir double"
    )
    older = (1, 1, 7, 3, True, 3, 0.0, 0.0, 9.0, 9.0, 0.0)
    out = models.kinematic_projection(spark.createDataFrame([older, row], schema)).orderBy("frame_id")
    got = [(r.frame_id, round(r.pred_x, 9), round(r.pred_y, 9)) for r in out.collect()]
    assert got == [(1, 10.2, 20.0), (2, 10.4, 20.0), (3, 10.6, 20.0)]
    fast = models.kinematic_projection(
        spark.createDataFrame([row], schema), "math", with_acceleration=True
    ).where("frame_id = 2").first()
    assert math.isclose(fast.pred_y, 20.0 + 2.0 * 0.2 + 0.5 * 0.04)


def test_trees_keep_no_node_cache(spark):
    """Nodes found by walking the tree are the cached ones, without a pass and files for each level."""
    rows = spark.range(600).selectExpr("CAST(id % 37 AS DOUBLE) AS a", "CAST(id % 11 AS DOUBLE) AS b", "CAST(id % 7 AS DOUBLE) AS x")
    rows = rows.coalesce(2).persist()
    settings = {**models.LAG_SETTINGS, "trees": 3, "depth": 4}
    plain = models._pipeline(["a", "b"], "x", "x", settings, None)
    assert plain.getStages()[1].getCacheNodeIds() is False
    cached = models._pipeline(["a", "b"], "x", "x", settings, None)
    cached.getStages()[1].setCacheNodeIds(True)
    told = [p.fit(rows).stages[1].toDebugString.split("\n", 1)[1] for p in (plain, cached)]
    assert told[0] == told[1]
    rows.unpersist()
