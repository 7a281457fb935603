"""Queries over hierarchical clusters, pivot and projection indexes, frame pairs and ball paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmotion.catalog import sqltext as X
from gridmotion.catalog.base import q, query, table, tracking
from gridmotion.catalog.features import K4, same
from gridmotion.operators import approximate, hierarchy, neighbors, pairs, pivots
from gridmotion.operators import normalize as N
from gridmotion.operators.rollups import first_row_per_play
from gridmotion.operators.sequences import formation_vectors
from gridmotion.schemas import PLAY_KEYS, ROW_KEYS, SIDE_KEYS

_PAIR = "game_id, play_id, frame_id, nfl_id"


@query(
    "frame_pairs",
    f"SELECT {_PAIR}, other_id AS other_nfl_id, same_side, {q('dist AS distance')} FROM pairs",
    ("norm", "pairs"),
)
def _(spark, sf):
    return pairs.frame_pairs(N.rightward(tracking(spark, sf)), x="x_norm", y="y_norm")


@query(
    "frame_pairs_within",
    f"SELECT {_PAIR}, other_id AS other_nfl_id, same_side, {q('dist AS distance')} FROM pairs WHERE dist < 7e0",
    ("norm", "pairs"),
)
def _(spark, sf):
    return pairs.frame_pairs(N.rightward(tracking(spark, sf)), 7.0, x="x_norm", y="y_norm")


_COUNTS = ", ".join(
    f"CAST(count(*) FILTER (WHERE {test} AND dist < {r}e0) AS BIGINT) AS {label}_within_{r}yds"
    for r in (3, 5, 7)
    for label, test in (("opponents", "NOT same_side"), ("teammates", "same_side"))
)


@query(
    "players_within",
    f"SELECT {_PAIR}, {_COUNTS} FROM norm LEFT JOIN pairs USING ({_PAIR}) GROUP BY {_PAIR}",
    ("norm", "pairs"),
)
def _(spark, sf):
    return pairs.players_within(N.rightward(tracking(spark, sf)), x="x_norm", y="y_norm")


@query(
    "ball_path",
    f"""SELECT game_id, play_id, CAST(frame AS BIGINT) AS frame,
      {q("x + (ball_land_x - x) * frame / CAST(num_frames_output AS DOUBLE) AS ball_x",
         "y + (ball_land_y - y) * frame / CAST(num_frames_output AS DOUBLE) AS ball_y")}
    FROM (SELECT * FROM tracking QUALIFY row_number() OVER (
      PARTITION BY game_id, play_id ORDER BY frame_id, nfl_id) = 1), generate_series(1, num_frames_output) AS g(frame)""",
)
def _(spark, sf):
    return pairs.ball_path(first_row_per_play(tracking(spark, sf)), PLAY_KEYS)


# ------------------------------------------------------------------ clusters of all densities

_VECTORS = """SELECT game_id, play_id, player_side, list_resize(flatten(list([x_norm, y_norm]
  ORDER BY y_norm, x_norm)), 22, 0e0) AS v FROM (SELECT *, row_number() OVER (
    PARTITION BY game_id, play_id, player_side ORDER BY y_norm, x_norm) AS rn FROM first_rows)
  WHERE rn <= 11 GROUP BY ALL"""
MIN_SAMPLES = 3


def _forest_sql(source: str) -> str:
    """Core distances and the weight of the spanning tree, grown from one point (Prim)."""
    return f"""WITH RECURSIVE src AS MATERIALIZED ({source}),
      pts AS MATERIALIZED (SELECT v, row_number() OVER (ORDER BY v) AS pid, count(*) AS n FROM src GROUP BY v),
      away AS MATERIALIZED (SELECT a.pid AS a, b.pid AS b, b.n, list_distance(a.v, b.v) AS d FROM pts a, pts b),
      counted AS (SELECT *, sum(n) OVER (PARTITION BY a ORDER BY d, b) AS upto FROM away),
      core AS MATERIALIZED (SELECT a AS pid, coalesce(min(d) FILTER (WHERE upto > {MIN_SAMPLES}), max(d)) AS core
        FROM counted GROUP BY a),
      reach AS MATERIALIZED (SELECT a, b, greatest(d, x.core, y.core) AS w FROM away
        JOIN core x ON x.pid = a JOIN core y ON y.pid = b WHERE a <> b),
      grown AS (SELECT [CAST(1 AS BIGINT)] AS held, 0e0 AS weight, CAST(1 AS BIGINT) AS n
        UNION ALL SELECT list_append(any_value(held), arg_min(b, (w, b))), any_value(weight) + min(w), any_value(n) + 1
        FROM grown JOIN reach ON list_contains(held, a) AND NOT list_contains(held, b)
        HAVING count(*) > 0)
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM pts) AS n_points, (SELECT CAST(sum(n) AS BIGINT) FROM pts) AS n_rows,
      {q("(SELECT sum(core) FROM core) AS core_sum", "(SELECT max(core) FROM core) AS core_max",
         "(SELECT max(weight) FROM grown) AS forest_weight")}"""


def _formations(spark, sf):
    return formation_vectors(N.rightward(tracking(spark, sf)), None)


@query("formation_forest", _forest_sql(_VECTORS), ("norm", "first_rows"))
def _(spark, sf):
    forest = hierarchy.spanning_forest(_formations(spark, sf), "vector", MIN_SAMPLES)
    points = forest.points.agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("weight").alias("n_rows"), F.sum("core").alias("core_sum"), F.max("core").alias("core_max")
    )
    return points.join(forest.edges.agg(F.sum("w").alias("forest_weight")), F.lit(True))  # a row each


@query(
    "formation_core_distances",
    f"""WITH src AS MATERIALIZED ({_VECTORS}),
      away AS (SELECT a.game_id, a.play_id, a.player_side, list_distance(a.v, b.v) AS d FROM src a, src b),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY game_id, play_id, player_side ORDER BY d) AS r FROM away)
    SELECT game_id, play_id, player_side, {q("d AS core")} FROM ranked WHERE r = {MIN_SAMPLES + 1}""",
    ("norm", "first_rows"),
)
def _(spark, sf):
    rows = _formations(spark, sf)
    forest = hierarchy.spanning_forest(rows, "vector", MIN_SAMPLES)
    core = forest.points.select("vec", "core")
    return rows.join(core, F.col("vector").cast("array<double>") == F.col("vec")).select(*SIDE_KEYS, "core")


@query("formation_hierarchy")
def _(spark, sf):
    """Clusters have no SQL; tests hold them against all pairs in plain Python."""
    return hierarchy.hierarchical_clusters(_formations(spark, sf), SIDE_KEYS, min_cluster_size=4, min_samples=MIN_SAMPLES)


# ------------------------------------------------------------------ neighbour indexes


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").withColumn("vec_id", F.col("vec_id").cast("bigint"))


@query(
    "formation_knn_by_pivots",
    f"""WITH src AS MATERIALIZED ({_VECTORS}),
      named AS (SELECT *, row_number() OVER (ORDER BY game_id, play_id, player_side) - 1 AS query_id FROM src),
      d AS (SELECT a.query_id, b.game_id, b.play_id, b.player_side, list_distance(a.v, b.v) AS distance FROM named a, src b),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, game_id, play_id, player_side) AS rank FROM d)
    SELECT query_id, game_id, play_id, player_side, {q("distance AS distance")}, rank FROM ranked WHERE rank <= 5""",
    ("norm", "first_rows"),
)
def _(spark, sf):
    from gridmotion.operators.skew import dense_index

    rows = _formations(spark, sf)
    asked = dense_index(rows, SIDE_KEYS, "query_id")
    return neighbors.knn(rows, asked, 5, SIDE_KEYS, "query_id", max_shipped_values=0)


@query(
    "embedding_knn_approximate",
    """SELECT CAST(5 * count(*) AS BIGINT) AS n_exact, true AS recall_reached FROM embeddings""",
)
def _(spark, sf):
    """All vectors against all, held against the exact search."""
    rows = _embeddings(spark, sf)
    index = approximate.fit_projections(rows, "embedding", 5, rows.count())
    found = approximate.approximate_knn(rows, rows, 5, ["vec_id"], "vec_id", "embedding", index)
    exact = neighbors.knn(rows, rows, 5, ["vec_id"], "vec_id", "embedding")
    told = approximate.recall(found, exact, ["vec_id"])
    return told.select("n_exact", (F.col("n_found") >= 0.9 * F.col("n_exact")).alias("recall_reached"))


@query(
    "embedding_block_shares",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS all_met_once FROM embeddings",
)
def _(spark, sf):
    """How the vectors lie in blocks, and that a search meets no block pair twice."""
    rows = _embeddings(spark, sf)
    n = rows.count()
    blocks = pivots.block_vectors(rows, ["vec_id"], "embedding", pivots.pick_pivots(rows, "embedding", n))
    met = pivots.nearest_rows(blocks, blocks, 5)[1]
    told = met.agg((F.count(F.lit(1)) == F.count_distinct("q_block", "block")).alias("all_met_once"))
    return blocks.intervals.agg(F.sum("n").alias("n_rows")).join(told, F.lit(True))  # a row each
