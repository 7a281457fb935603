"""Queries over evaluation, neighbours, clusters, models and the kinematic baseline."""

from __future__ import annotations

import threading

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gridmotion.catalog import sqltext as X
from gridmotion.catalog.base import labels, q, query, table, tracking
from gridmotion.catalog.features import K4, same
from gridmotion.catalog.relations import digest_sql, fraction_sql, number_sql
from gridmotion.functions import scalars as S
from gridmotion.operators import density, evaluate, models, neighbors, sampling
from gridmotion.operators.joins import predictions_with_truth
from gridmotion.operators.normalize import fit_scaler, rightward
from gridmotion.operators.sequences import formation_vectors
from gridmotion.plans import tables as P
from gridmotion.schemas import PLAY_KEYS, ROW_KEYS, SIDE_KEYS, T0_FEATURES, TIMELINE_KEYS
from gridmotion.session import scratch_path
from gridmotion.sources.files import write_csv

def matched_projection(spark, sf):
    return predictions_with_truth(kinematic(spark, sf), labels(spark, sf))


# ------------------------------------------------------------------ baseline and errors


@query(
    "kinematic_projection",
    f"SELECT {K4}, {same('pred_x', 'pred_y')} FROM projected",
    ("last_rows", "projected"),
)
def kinematic(spark, sf):
    return models.kinematic_projection(tracking(spark, sf))


@query(
    "kinematic_projection_accelerated",
    f"""SELECT {K4}, {q("pred_x + a * cos(radians(dir)) * t * t * 0.5e0 AS pred_x",
      "pred_y + a * sin(radians(dir)) * t * t * 0.5e0 AS pred_y")}
    FROM (SELECT game_id, play_id, nfl_id, k AS frame_id, a, dir, k * 0.1e0 AS t,
      x + s * cos(radians(dir)) * k * 0.1e0 AS pred_x, y + s * sin(radians(dir)) * k * 0.1e0 AS pred_y
      FROM last_rows, unnest(range(1, num_frames_output + 1)) AS r(k) WHERE player_to_predict)""",
    ("last_rows",),
)
def _(spark, sf):
    return models.kinematic_projection(tracking(spark, sf), "math", with_acceleration=True)


_FACTORS = {"mean_sq2d": "1e0", "half": "0.5e0", "elementwise": "0.5e0", "elementwise_half": "0.25e0"}


@query(
    "rmse_modes",
    " UNION ALL ".join(
        f"""SELECT '{mode}' AS mode, CAST(count(*) AS BIGINT) AS n_points,
          {q(f"sqrt(avg({X.SQ}) * {factor}) AS rmse")} FROM matched"""
        for mode, factor in _FACTORS.items()
    ),
    X.MATCHED,
)
def _(spark, sf):
    return evaluate.all_rmse_modes(matched_projection(spark, sf))


@query(
    "rmse_play_averaged",
    f"""SELECT CAST(count(*) AS BIGINT) AS n_plays, {q("avg(r) AS rmse")}
    FROM (SELECT sqrt(avg({X.SQ})) AS r FROM matched GROUP BY game_id, play_id)""",
    X.MATCHED,
)
def _(spark, sf):
    return evaluate.play_averaged_rmse(matched_projection(spark, sf))


@query(
    "rmse_with_padding",
    f"""SELECT CAST(count(*) AS BIGINT) AS n_sequences, {q("sqrt(0.5e0 * sum(sq) / (count(*) * 15)) AS rmse")}
    FROM (SELECT sum({X.SQ}) AS sq FROM matched GROUP BY game_id, play_id, nfl_id)""",
    X.MATCHED,
)
def _(spark, sf):
    return evaluate.padded_rmse(matched_projection(spark, sf), TIMELINE_KEYS, 15)


@query(
    "evaluate_by_play",
    f"""SELECT game_id, play_id, CAST(count(*) AS BIGINT) AS n_points, {q(f"sqrt(avg({X.SQ})) AS rmse")}
    FROM matched GROUP BY game_id, play_id""",
    X.MATCHED,
)
def _(spark, sf):
    return evaluate.evaluate_predictions(kinematic(spark, sf), labels(spark, sf), by_play=True)


@query(
    "mean_fold_score",
    f"""SELECT {q("avg(r) AS mean_score")}, CAST(count(*) AS BIGINT) AS n_folds
    FROM (SELECT sqrt(avg({X.SQ})) AS r FROM matched GROUP BY nfl_id % 3)""",
    X.MATCHED,
)
def _(spark, sf):
    folds = matched_projection(spark, sf).withColumn("fold", F.col("nfl_id") % 3)
    return evaluate.mean_fold_score(evaluate.rmse(folds, by=["fold"]))


# ------------------------------------------------------------------ neighbours

_DIST = "sqrt(" + " + ".join(
    f"(c.{n} - p.{n}) * (c.{n} - p.{n})"
    for n in ("width_x", "width_y", "center_x", "center_y", "mean_dist_to_center")
) + ")"
_KEY = {"game_id": 2024000000, "play_id": 2, "player_side": "Offense"}
_NEAREST = f"""SELECT c.game_id, c.play_id, c.player_side, {q(f"{_DIST} AS distance")}
  FROM matrix c, (SELECT * FROM matrix WHERE {{pick}}) p
  ORDER BY {_DIST}, c.game_id, c.play_id, c.player_side LIMIT 5"""


@query(
    "formation_knn_by_key",
    _NEAREST.format(pick="game_id = 2024000000 AND play_id = 2 AND player_side = 'Offense'"),
    X.MATRIX,
)
def _(spark, sf):
    index = neighbors.build_formation_index(rightward(tracking(spark, sf)))
    return neighbors.nearest_by_key(index, _KEY, 5)


@query(
    "formation_knn_by_index",
    _NEAREST.format(
        pick="(game_id, play_id, player_side) IN (SELECT (game_id, play_id, player_side) FROM matrix"
        " ORDER BY game_id, play_id, player_side LIMIT 1 OFFSET 4)"
    ),
    X.MATRIX,
)
def _(spark, sf):
    index = neighbors.build_formation_index(rightward(tracking(spark, sf)))
    return neighbors.nearest_by_index(index, 4, 5)


@query(
    "formation_knn_saved",
    _NEAREST.format(pick="game_id = 2024000000 AND play_id = 2 AND player_side = 'Offense'"),
    X.MATRIX,
)
def _(spark, sf):
    path = scratch_path(spark, "formation_index")
    neighbors.build_formation_index(rightward(tracking(spark, sf)), None, path)
    return neighbors.nearest_by_key(neighbors.load_formation_index(spark, path), _KEY, 5)


_EMB_KNN = f"""WITH v AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  d AS (SELECT a.vec_id AS query_id, b.vec_id, list_distance(a.e, b.e) AS distance FROM v a, v b)
  SELECT query_id, vec_id, {q("distance AS distance")}, rank FROM (SELECT *, CAST(row_number() OVER
    (PARTITION BY query_id ORDER BY distance, vec_id) AS BIGINT) AS rank FROM d) WHERE rank <= 5"""


def _embedding_knn(spark, sf, **options):
    corpus = table(spark, sf, "embeddings").withColumn("vec_id", F.col("vec_id").cast("bigint"))
    return neighbors.knn(corpus, corpus, 5, ["vec_id"], "vec_id", "embedding", **options)


@query("embedding_knn", _EMB_KNN)
def _(spark, sf):
    return _embedding_knn(spark, sf)


@query("embedding_knn_by_blocks", _EMB_KNN)
def _(spark, sf):
    return _embedding_knn(spark, sf, max_shipped_values=0)


# ------------------------------------------------------------------ density clusters


def _cluster_sql(source: str, keys: str, eps: float, min_samples: int, min_size: int) -> str:
    """The clustering rule on all pairs; source has the key columns and a list v."""
    return f"""WITH RECURSIVE src AS MATERIALIZED ({source}),
      pts AS MATERIALIZED (SELECT v, row_number() OVER (ORDER BY v) AS pid, n
        FROM (SELECT v, count(*) AS n FROM src GROUP BY v)),
      near AS MATERIALIZED (SELECT a.pid AS a, b.pid AS b, b.n, list_distance(a.v, b.v) AS d
        FROM pts a, pts b WHERE list_distance(a.v, b.v) <= {eps}),
      core AS MATERIALIZED (SELECT a AS pid FROM near GROUP BY a HAVING sum(n) >= {min_samples}),
      link AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
      reach AS (SELECT pid AS a, pid AS b FROM core
        UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
      roots AS (SELECT a AS pid, min(b) AS root FROM reach GROUP BY a),
      nearest AS (SELECT a AS pid, arg_min(b, (d, b)) AS core_pid, min(d) AS d FROM near
        WHERE a NOT IN (FROM core) AND b IN (FROM core) GROUP BY a),
      members AS (SELECT pid, root, 1e0 AS prob FROM roots UNION ALL
        SELECT m.pid, r.root, 1e0 - m.d / {eps} FROM nearest m JOIN roots r ON r.pid = m.core_pid),
      kept AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (
        SELECT root FROM members JOIN pts USING (pid) GROUP BY root HAVING sum(n) >= {min_size}))
    SELECT {keys}, CAST(coalesce(cluster, -1) AS BIGINT) AS cluster,
      {q("CASE WHEN cluster IS NULL THEN 0e0 ELSE prob END AS cluster_prob")}
    FROM src JOIN pts USING (v) LEFT JOIN members USING (pid) LEFT JOIN kept USING (root)"""


_VECTORS = """SELECT game_id, play_id, player_side, list_resize(flatten(list([x_norm, y_norm]
  ORDER BY y_norm, x_norm)), 22, 0e0) AS v FROM (SELECT *, row_number() OVER (
    PARTITION BY game_id, play_id, player_side ORDER BY y_norm, x_norm) AS rn FROM first_rows)
  WHERE rn <= 11 GROUP BY ALL"""
_FORMATIONS = _cluster_sql(_VECTORS, "game_id, play_id, player_side", 88.0, 3, 4)
_FIRST = ("norm", "first_rows")


def _formation_clusters(spark, sf):
    vectors = formation_vectors(rightward(tracking(spark, sf)), None)
    return density.density_clusters(
        vectors, SIDE_KEYS, eps=88.0, min_samples=3, min_cluster_size=4
    )


@query("formation_clusters", _FORMATIONS, _FIRST)
def _(spark, sf):
    return _formation_clusters(spark, sf)


@query(
    "embedding_clusters",
    _cluster_sql(
        "SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
        "vec_id",
        1.141,
        4,
        5,
    ),
)
def _(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("vec_id", F.col("vec_id").cast("bigint"))
    return density.density_clusters(rows, ["vec_id"], "embedding", 1.141, 4, 5)


@query(
    "cluster_examples",
    f"SELECT * FROM ({_FORMATIONS}) WHERE cluster = 0 ORDER BY game_id, play_id, player_side LIMIT 10",
    _FIRST,
)
def _(spark, sf):
    return sampling.cluster_examples(_formation_clusters(spark, sf), 0, 10)


@query("distinct_clusters", f"SELECT DISTINCT cluster FROM ({_FORMATIONS})", _FIRST)
def _(spark, sf):
    return _formation_clusters(spark, sf).select("cluster").distinct()


# ------------------------------------------------------------------ models
#
# Fitted values are Spark's own, so each query reports what SQL can state of a full run: the
# rows of every part, that no row lacks a prediction, and that the model beats the mean.

_LAGGED = f"""(SELECT {K4} FROM (SELECT {K4}, {", ".join(
    f"lag({c}, 5) OVER (PARTITION BY game_id, play_id, nfl_id ORDER BY frame_id) AS {c}5"
    for c in ("x", "y"))} FROM tracking) WHERE x5 IS NOT NULL AND y5 IS NOT NULL)"""
_T0_ROWS = f"(SELECT {K4} FROM labels JOIN (SELECT game_id, play_id, nfl_id FROM last_rows) USING (game_id, play_id, nfl_id))"


def _split_report(rows: str, keys: list[str]) -> str:
    share = fraction_sql(keys)
    return f"""SELECT CAST(count(*) FILTER (WHERE {share} < 0.8e0) AS BIGINT) AS n_train,
      CAST(count(*) FILTER (WHERE {share} >= 0.8e0) AS BIGINT) AS n_test,
      CAST(0 AS BIGINT) AS n_missing, true AS beats_mean FROM {rows}"""


def _report(spark, **values):
    kinds = {bool: "boolean", int: "bigint"}
    schema = ", ".join(f"{name} {kinds[type(v)]}" for name, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema)


def _missing(scored) -> int:
    return scored.where("pred_x IS NULL OR pred_y IS NULL").count()


def _lags(spark, sf):
    rows = P.lag_training_table(tracking(spark, sf), 5)
    return rows, P.lag_features(rows.columns, 5)


def _lag_report(spark, sf, keys):
    rows, features = _lags(spark, sf)
    _, scored, error = models.holdout_error(rows, features, split_keys=keys)
    parts = sampling.train_test(rows, keys=keys)
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    return _report(
        spark,
        n_train=train.count(),
        n_test=scored.count(),
        n_missing=_missing(scored),
        beats_mean=error.first().rmse < models.mean_baseline(train, test),
    )


@query("boosted_lag_model", _split_report(_LAGGED, PLAY_KEYS))
def _(spark, sf):
    return _lag_report(spark, sf, PLAY_KEYS)


@query("boosted_lag_model_row_split", _split_report(_LAGGED, ROW_KEYS))
def _(spark, sf):
    return _lag_report(spark, sf, ROW_KEYS)


def _t0(spark, sf):
    return P.t0_training_table(tracking(spark, sf), labels(spark, sf))


_FITTED: dict[tuple[str, str], models.AxisModels] = {}
_FITTING = threading.Lock()


def _t0_scored(spark, sf):
    """The full t0 model scored on its training rows; a session fits it once per data folder."""
    rows, key = _t0(spark, sf), (spark.sparkContext.applicationId, sf)
    with _FITTING:
        if key not in _FITTED:
            _FITTED[key] = models.fit_axes(rows, T0_FEATURES, settings=models.T0_SETTINGS)
    return _FITTED[key], rows, models.score(_FITTED[key], rows, T0_FEATURES, ROW_KEYS)


@query(
    "boosted_t0_model",
    f"SELECT {K4}, true AS predicted FROM {_T0_ROWS}",
    ("last_rows",),
)
def _(spark, sf):
    scored = _t0_scored(spark, sf)[2]
    known = F.col("pred_x").isNotNull() & F.col("pred_y").isNotNull()
    return scored.select(*ROW_KEYS, known.alias("predicted"))


@query(
    "boosted_t0_play_error",
    f"""SELECT CAST(count(DISTINCT (game_id, play_id)) AS BIGINT) AS n_plays, true AS beats_mean
    FROM {_T0_ROWS}""",
    ("last_rows",),
)
def _(spark, sf):
    _, rows, scored = _t0_scored(spark, sf)
    truth = labels(spark, sf)
    error = evaluate.play_averaged_rmse(predictions_with_truth(scored, truth), PLAY_KEYS).first()
    mean = rows.agg(F.avg("x"), F.avg("y")).first()
    flat = rows.select(*ROW_KEYS, F.lit(mean[0]).alias("pred_x"), F.lit(mean[1]).alias("pred_y"))
    plain = evaluate.play_averaged_rmse(predictions_with_truth(flat, truth), PLAY_KEYS).first()
    return _report(spark, n_plays=error.n_plays, beats_mean=error.rmse < plain.rmse)


SEARCH_SEQUENCES = 300  # labelled sequences a registered search draws

STAGED_ROUNDS = 40


def _search_sql(part: str, where: str = "") -> str:
    """Rows each trial was scored on: of the first sequences in digest order, by part."""
    return f"""WITH t0 AS ({_T0_ROWS[1:-1]}),
      drawn AS (SELECT game_id, play_id, nfl_id FROM (SELECT DISTINCT game_id, play_id, nfl_id FROM t0)
        ORDER BY {digest_sql(TIMELINE_KEYS)}, game_id, play_id, nfl_id LIMIT {SEARCH_SEQUENCES}),
      parts AS (SELECT {part} AS part, CAST(count(*) AS BIGINT) AS n_rows
        FROM t0 JOIN drawn USING (game_id, play_id, nfl_id) {where} GROUP BY 1)
    SELECT CAST(trial AS BIGINT) AS trial, part, n_rows, true AS best_is_least FROM parts, range(1, 5) AS r(trial)"""


def _search_report(spark, sf, k):
    result = models.search_settings(_t0(spark, sf), T0_FEATURES, k=k, n_sequences=SEARCH_SEQUENCES)
    least = result.history_table(spark).agg((F.min("error") == F.lit(result.score)).alias("best_is_least"))
    return result.parts_table(spark).drop("error").join(least, F.lit(True))  # a row


@query(
    "settings_search_folds",
    _search_sql(f"concat('fold ', CAST({number_sql(TIMELINE_KEYS)} % 3 AS VARCHAR))"),
    ("last_rows",),
)
def _(spark, sf):
    return _search_report(spark, sf, 3)


@query("settings_search_holdout", _search_sql("'held out'", f"WHERE {fraction_sql(PLAY_KEYS)} >= 0.8e0"), ("last_rows",))
def _(spark, sf):
    return _search_report(spark, sf, None)


@query(
    "early_stopped_model",
    f"SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_missing, true AS stopped FROM {_T0_ROWS}",
    ("last_rows",),
)
def _(spark, sf):
    rows = _t0(spark, sf)
    fitted = models.early_stopped_fit(rows, T0_FEATURES, settings=models.T0_SETTINGS)
    scored = models.score(fitted, rows, T0_FEATURES, ROW_KEYS)
    return _report(
        spark,
        n_rows=scored.count(),
        n_missing=_missing(scored),
        stopped=max(fitted.n_trees()) < models.T0_SETTINGS["trees"],
    )


@query(
    "batch_scoring_saved_model",
    f"SELECT {K4}, true AS as_before FROM {_T0_ROWS}",
    ("last_rows",),
)
def _(spark, sf):
    path = scratch_path(spark, "bundle")
    fitted, rows, before = _t0_scored(spark, sf)
    index = P.player_index(tracking(spark, sf))
    models.save_bundle(fitted, index, fit_scaler(rows, ["x", "y"]), path)
    loaded, known, _ = models.load_bundle(spark, path)
    scored = models.score(loaded, rows.join(known, "nfl_id"), loaded.features, ROW_KEYS)
    out = scratch_path(spark, "scored.csv")
    write_csv(scored, out)
    again = spark.read.schema(scored.schema).option("header", True).csv(out)
    first = before.select(*ROW_KEYS, F.col("pred_x").alias("x0"), F.col("pred_y").alias("y0"))
    same_values = (F.col("pred_x") == F.col("x0")) & (F.col("pred_y") == F.col("y0"))
    return again.join(first, ROW_KEYS).select(*ROW_KEYS, same_values.alias("as_before"))


@query(
    "python_model_scoring",
    f"SELECT {K4}, true AS finite FROM {_T0_ROWS}",
    ("last_rows",),
)
def _(spark, sf):
    """A linear model fitted here by least squares, scored in Arrow batches by NumPy."""
    rows = _t0(spark, sf).withColumns({c: S.zero_if_not_finite(F.col(c)) for c in T0_FEATURES})
    terms = VectorAssembler(inputCols=T0_FEATURES, outputCol="terms").transform(rows.dropna(subset=["x", "y"]))
    fits = [LinearRegression(featuresCol="terms", labelCol=t, regParam=0.01).fit(terms) for t in ("x", "y")]
    weights = [(fit.coefficients.toArray(), fit.intercept) for fit in fits]

    def predict(batch):
        values = batch[T0_FEATURES].to_numpy()
        (wx, bx), (wy, by) = weights
        return batch[ROW_KEYS].assign(pred_x=values @ wx + bx, pred_y=values @ wy + by)

    scored = models.score_with_python(
        rows,
        [*ROW_KEYS, *T0_FEATURES],
        predict,
        "game_id long, play_id long, nfl_id long, frame_id int, pred_x double, pred_y double",
    )
    return scored.select(*ROW_KEYS, (S.is_finite(F.col("pred_x")) & S.is_finite(F.col("pred_y"))).alias("finite"))


@query(
    "staged_model",
    f"""SELECT axis, CAST({STAGED_ROUNDS} AS BIGINT) AS n_rounds, (SELECT CAST(count(*) AS BIGINT) FROM {_T0_ROWS}) AS n_scored,
      true AS best_is_least, true AS cut_back FROM (SELECT unnest(['x', 'y']) AS axis)""",
    ("last_rows",),
)
def _(spark, sf):
    """Errors of all rounds on held-out plays; the model keeps the rounds up to the best one."""
    rows = _t0(spark, sf)
    settings = {**models.T0_SETTINGS, "trees": STAGED_ROUNDS}
    fitted = models.staged_fit(rows, T0_FEATURES, settings=settings, patience=STAGED_ROUNDS)
    scored = models.score(fitted.models, rows, T0_FEATURES, ROW_KEYS).where("pred_x IS NOT NULL AND pred_y IS NOT NULL")
    history = fitted.history_table(spark)
    trees = dict(zip(("x", "y"), fitted.models.n_trees()))
    kept = spark.createDataFrame([(axis, n) for axis, n in trees.items()], "axis string, trees int")
    least = F.min(F.struct("error", "round"))["round"]
    told = history.groupBy("axis").agg(
        F.count(F.lit(1)).alias("n_rounds"), least.alias("least"), F.max(F.when(F.col("kept"), F.col("round"))).alias("last")
    )
    return told.join(kept, "axis").join(scored.agg(F.count(F.lit(1)).alias("n_scored")), F.lit(True)).select(
        "axis", "n_rounds", "n_scored", (F.col("least") == F.col("last")).alias("best_is_least"), (F.col("trees") == F.col("last")).alias("cut_back")
    )
