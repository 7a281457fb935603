"""Chunk manifests, samples by threshold, frame pairs, staged boosting and approximate search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmotion.catalog.base import labels, tracking
from gridmotion.functions.scalars import key_digest
from gridmotion.operators import approximate, models, neighbors, pairs, sampling, summaries
from gridmotion.operators.spatial import coverage_features
from gridmotion.plans import chunks
from gridmotion.plans.tables import t0_training_table
from gridmotion.schemas import PLAY_KEYS, T0_FEATURES


# ------------------------------------------------------------------ chunk manifest


def _plays(spark, paths):
    return sorted(map(str, spark.read.parquet(paths["plays"]).collect()))


@pytest.mark.parametrize("stop", ["teamframe", "plays", "manifest"])
def test_interrupted_run_is_resumed(spark, sf_dir, tmp_path, stop):
    rows = tracking(spark, sf_dir).where("week <= 2")
    chunks.build_in_chunks(spark, rows, str(tmp_path / "a"), stop_before=stop)
    assert chunks.published(spark, str(tmp_path / "a"), ["week"]) is None
    resumed = chunks.build_in_chunks(spark, rows, str(tmp_path / "a"))
    whole = chunks.build_in_chunks(spark, rows, str(tmp_path / "b"))
    assert _plays(spark, resumed) == _plays(spark, whole)
    assert chunks.pending_chunks(rows, str(tmp_path / "a"), ["week"]).isEmpty()


def test_late_and_changed_rows_are_built_anew(spark, sf_dir, tmp_path):
    rows, out = tracking(spark, sf_dir), str(tmp_path)
    keys = ["game_id"]
    chunks.build_in_chunks(spark, rows.where("frame_id <= 10"), out, keys)
    first = rows.agg(F.min("game_id")).first()[0]
    late = rows.where(f"frame_id <= 10 OR game_id = {first}")
    due = chunks.pending_chunks(late, out, keys)
    assert [r["game_id"] for r in due.collect()] == [first]
    changed = rows.where("frame_id <= 10").withColumn("x", F.when(F.col("game_id") == first, F.col("x") + 1).otherwise(F.col("x")))
    assert [r["game_id"] for r in chunks.pending_chunks(changed, out, keys).collect()] == [first]
    paths = chunks.build_in_chunks(spark, rows, out, keys)
    whole = chunks.build_in_chunks(spark, rows, str(tmp_path / "whole"), keys)
    assert _plays(spark, paths) == _plays(spark, whole)
    runs = spark.read.parquet(f"{out}/manifest").groupBy("game_id").agg(F.max("run").alias("run")).collect()
    assert {r["run"] for r in runs} == {2}


def test_a_play_across_chunks_is_refused(spark, sf_dir, tmp_path):
    with pytest.raises(ValueError, match="several chunks"):
        chunks.build_in_chunks(spark, tracking(spark, sf_dir), str(tmp_path), ["frame_id"])


# ------------------------------------------------------------------ samples


@pytest.mark.parametrize("n", [0, 1, 10, 450, 499, 500, 900])
@pytest.mark.parametrize("border", [1, 100_000])
def test_sample_is_the_first_in_digest_order(spark, n, border):
    df = spark.range(500).withColumnRenamed("id", "k").union(spark.range(40).toDF("k"))
    picked = sampling.sample_keys(df, n, ["k"], 7, border)
    want = df.distinct().withColumn("d", key_digest(["k"], 7)).orderBy("d").limit(n)
    assert sorted(r["k"] for r in picked.collect()) == sorted(r["k"] for r in want.collect())
    assert "TakeOrdered" not in picked._jdf.queryExecution().toString()


# ------------------------------------------------------------------ pairs and paths


def test_pairs_of_a_crowded_frame(spark):
    rng = random.Random(4)
    rows = [(1, 1, 1, i, rng.choice("ab"), rng.uniform(0, 400), rng.uniform(0, 400)) for i in range(3000)]
    rows += [(1, 1, 2, i, "a", None if i == 0 else float(i), 0.0) for i in range(4)] + [(1, 1, None, 9, "a", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "game_id long, play_id long, frame_id int, nfl_id long, player_side string, x double, y double")
    near = pairs.frame_pairs(df, 7.0).collect()
    want = {}
    for f in (1, 2):
        own = [r for r in rows if r[2] == f and r[5] is not None]
        at = np.array([r[5:] for r in own])
        away = np.sqrt(((at[:, None] - at[None]) ** 2).sum(axis=2))
        for i, j in zip(*np.nonzero(away < 7.0)):
            if i != j:
                want[f, own[i][3], own[j][3]] = (own[i][4] == own[j][4], away[i, j])
    assert {(r["frame_id"], r["nfl_id"], r["other_nfl_id"]): r["same_side"] for r in near} == {k: v[0] for k, v in want.items()}
    assert all(math.isclose(r["distance"], want[r["frame_id"], r["nfl_id"], r["other_nfl_id"]][1]) for r in near)
    counts = {(r["frame_id"], r["nfl_id"]): r["opponents_within_5yds"] for r in pairs.players_within(df).collect()}
    assert counts == {(r[2], r[3]): sum(not s and d < 5 for (f, a, _), (s, d) in want.items() if (f, a) == (r[2], r[3])) for r in rows if r[2]}
    # The same counts as the features that meet whole frames, where those are counts.
    small = df.where("frame_id = 2")
    covered = {r["nfl_id"]: r["teammates_within_3yds"] or 0 for r in coverage_features(small).collect()}
    assert {r["nfl_id"]: r["teammates_within_3yds"] for r in pairs.players_within(small).collect()} == covered
    assert pairs.frame_pairs(df.where("frame_id = 2")).count() == 12
    with pytest.raises(ValueError):
        pairs.frame_pairs(df, 0.0)


def test_pairs_start_no_job(spark, sf_dir):
    tracker = spark.sparkContext.statusTracker()
    rows = tracking(spark, sf_dir)  # reading the schema is a job
    before = set(tracker.getJobIdsForGroup(None))
    pairs.players_within(rows)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_long_spans_are_split(spark):
    df = spark.createDataFrame([(1, 2500), (2, 1), (3, 0), (4, None)], "k long, n int")
    got = pairs.spans_to_frames(df, F.col("n"), span_rows=1000).groupBy("k").agg(F.count(F.lit(1)), F.min("frame"), F.max("frame"))
    assert sorted(map(tuple, got.collect())) == [(1, 2500, 1, 2500), (2, 1, 1, 1)]
    flights = [(1, 0.0, 8.0, 10.0, 4.0, 4), (2, 0.0, None, 10.0, 4.0, 2)]
    df = spark.createDataFrame(flights, "k long, x double, y double, ball_land_x double, ball_land_y double, num_frames_output int")
    rows = pairs.ball_path(df, ["k"]).orderBy("k", "frame").collect()
    assert [(r["ball_x"], r["ball_y"]) for r in rows[:4]] == [(2.5, 7.0), (5.0, 6.0), (7.5, 5.0), (10.0, 4.0)]
    assert len(rows) == 6 and all(math.isnan(r[c]) for r in rows[4:] for c in ("ball_x", "ball_y"))


# ------------------------------------------------------------------ staged boosting


@pytest.mark.parametrize("errors,patience,want", [([3, 2, 1], 1, (3, 3)), ([3, 2, 2.5, 1], 1, (2, 3)), ([3, 2, 2.5, 1], 2, (4, 4)), ([1, 1, 1, 1], 2, (1, 3)), ([5], 3, (1, 1))])
def test_best_round(errors, patience, want):
    assert models.best_round(errors, patience) == want


def test_staged_fit_is_cut_to_its_best_round(spark, sf_dir):
    rows = t0_training_table(tracking(spark, sf_dir), labels(spark, sf_dir))
    fitted = models.staged_fit(rows, T0_FEATURES, settings={"trees": 12, "depth": 3, "step": 0.9}, patience=3)
    assert dict(zip(("x", "y"), fitted.models.n_trees())) == fitted.best_round
    parts = sampling.split_column(rows, {"train": 0.8, "validate": 0.2}, seed=42).where("split = 'validate'")
    for axis in ("x", "y"):
        errors = fitted.errors[axis]
        assert min(errors) == errors[fitted.best_round[axis] - 1] and len(errors) == fitted.rounds_run[axis]
        scored = models.score(fitted.models, parts, T0_FEATURES, [*PLAY_KEYS, axis])
        error = scored.agg(F.sqrt(F.avg((F.col(f"pred_{axis}") - F.col(axis)) ** 2))).first()[0]
        assert math.isclose(error, min(errors), rel_tol=1e-9)


# ------------------------------------------------------------------ approximate search, summaries


def test_approximate_neighbours(spark):
    rng = np.random.default_rng(6)
    middle = rng.normal(0, 10, (20, 24))
    rows = middle[rng.integers(0, 20, 3000)] + rng.normal(0, 1, (3000, 24))
    rows[100:1100] = rows[100]  # a third are copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)] + [(9999, None)], "id long, vector array<double>")
    index = approximate.fit_projections(df, "vector", 5, 3000)
    found = approximate.approximate_knn(df, df, 5, ["id"], "id", "vector", index).cache()
    exact = neighbors.knn(df.where("vector IS NOT NULL"), df.where("vector IS NOT NULL"), 5, ["id"], "id")
    n_exact, n_found = approximate.recall(found, exact, ["id"]).first()
    assert n_exact == 15000 and n_found >= 0.9 * n_exact and index.probes < 2 ** index.cuts.shape[1]
    copies = found.where("query_id = 500").orderBy("rank").collect()
    assert [(r["id"], r["distance"]) for r in copies] == [(i, 0.0) for i in range(100, 105)]
    assert found.groupBy("query_id", "id").count().where("count > 1").isEmpty()


def test_approximate_search_stores_no_query_by_probe(spark, monkeypatch):
    rows = np.random.default_rng(7).normal(size=(1500, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, vector array<double>")
    index = approximate.fit_projections(df, "vector", 3, 1500)
    index.probes = 2 ** index.cuts.shape[1]  # all buckets: the answers are exact
    paths, scratch = [], approximate.scratch_path
    monkeypatch.setattr(approximate, "scratch_path", lambda *a: paths.append(scratch(*a)) or paths[-1])
    found = approximate.approximate_knn(df, df, 3, ["id"], "id", "vector", index).collect()
    away = np.linalg.norm(rows[:, None] - rows[None], axis=2)
    assert {(r["query_id"], r["rank"], r["id"]) for r in found} == {(q, n + 1, i) for q in range(1500) for n, i in enumerate(np.argsort(away[q])[:3])}
    assert max(spark.read.parquet(p).count() for p in paths) <= approximate.TABLES * 1500


def test_summaries_hold_the_quantile(spark):
    rng = random.Random(8)
    rows = [(k, p, rng.gauss(0, 1) if k else float(rng.randint(0, 5))) for k in range(3) for p in range(5) for _ in range(4000)]
    df = spark.createDataFrame(rows + [(0, 0, None), (0, 1, float("nan"))], "k int, part int, v double")
    merged = summaries.merge_summaries(summaries.quantile_summaries(df, ["k", "part"], "v", 512), ["k"], 512)
    for share in (0.0, 0.1, 0.5, 0.9, 1.0):
        for r in summaries.summarized_quantile(merged, share, "q", 512).collect():
            own = sorted(v for k, _, v in rows if k == r["k"])
            exact = own[max(0, math.ceil(share * len(own)) - 1)]
            assert r["n_values"] == 20000 and r["q_low"] <= exact <= r["q_high"]
