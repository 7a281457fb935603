"""Queries over joins, aggregations, set operations, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmotion.catalog import sqltext as X
from gridmotion.catalog.base import labels, q, query, table, tracking
from gridmotion.catalog.features import K4, NORM, same
from gridmotion.operators import joins, rollups, sampling, skew, summaries
from gridmotion.operators.normalize import column_moments, rightward
from gridmotion.plans import tables as P
from gridmotion.schemas import (
    PLAYER_COLUMNS,
    PLAY_KEYS,
    ROW_KEYS,
    SIDE_FRAME_KEYS,
    SIDE_KEYS,
    T0_FEATURES,
    TEAMFRAME_FEATURES,
    TIMELINE_KEYS,
)
from gridmotion.sources.files import union_all, union_strict

K3 = "game_id, play_id, nfl_id"
KS = "game_id, play_id, player_side"
KF = "game_id, play_id, frame_id"

# ------------------------------------------------------------------ joins


@query(
    "frame_aligned_join",
    f"""SELECT {K4}, {q("t.x AS x", "t.y AS y", "l.x AS x_label", "l.y AS y_label")}
    FROM tracking t JOIN labels l USING ({K4})""",
)
def _(spark, sf):
    joined = joins.frame_aligned_join(tracking(spark, sf), labels(spark, sf))
    return joined.select(*ROW_KEYS, "x", "y", "x_label", "y_label")


_LAST_LABEL = f"""SELECT {K3}, arg_max(x, frame_id) FILTER (WHERE x IS NOT NULL) AS tx,
  arg_max(y, frame_id) FILTER (WHERE y IS NOT NULL) AS ty FROM labels GROUP BY {K3}"""


@query(
    "last_label_join",
    f"SELECT {K4}, {same('tx', 'ty')} FROM tracking LEFT JOIN ({_LAST_LABEL}) USING ({K3})",
)
def _(spark, sf):
    joined = joins.with_last_label(tracking(spark, sf), labels(spark, sf))
    return joined.select(*ROW_KEYS, "tx", "ty")


_T0_SQL = f"""SELECT l.game_id, l.play_id, l.nfl_id, l.frame_id,
  {q("t.x AS x_t0", "t.y AS y_t0", "t.s AS s", "t.a AS a", "t.o AS o", "t.dir AS dir")},
  t.player_weight, t.absolute_yardline_number, l.frame_id AS rel_frame, t.num_frames_output,
  {q("l.x AS x", "l.y AS y")}
  FROM labels l JOIN last_rows t USING ({K3}) WHERE t.player_to_predict"""


@query("t0_join", _T0_SQL, ("last_rows",))
def _(spark, sf):
    joined = joins.t0_join(tracking(spark, sf), labels(spark, sf))
    return joined.select(*ROW_KEYS, *T0_FEATURES, "x", "y")


@query("t0_training_table", _T0_SQL, ("last_rows",))
def t0_table(spark, sf):
    return P.t0_training_table(tracking(spark, sf), labels(spark, sf))


_LAGS = [f"{c}_prior{k}" for k in range(1, 6) for c in ("x", "y")]


@query(
    "lag_training_table",
    f"""SELECT {K4}, {same(*_LAGS, "s", "a", "dir", "o", "x", "y")} FROM (SELECT *, {", ".join(
      f"lag({c}, {k}) OVER (PARTITION BY {K3} ORDER BY frame_id) AS {c}_prior{k}"
      for k in range(1, 6) for c in ("x", "y"))} FROM tracking)
    WHERE x_prior5 IS NOT NULL AND y_prior5 IS NOT NULL""",
)
def lag_table(spark, sf):
    return P.lag_training_table(tracking(spark, sf), 5)




@query(
    "join_teamframe",
    f"""SELECT {K4}, {q("x_norm AS x_norm", *[f"coalesce({c}, 0) AS {c}" for c in TEAMFRAME_FEATURES])}
    FROM norm LEFT JOIN teamframe USING ({KF}, player_side)""",
    X.TEAMFRAME,
)
def _(spark, sf):
    rows = tracking(spark, sf)
    joined = joins.join_teamframe(rightward(rows), P.teamframe_table(rows))
    return joined.select(*ROW_KEYS, "x_norm", *TEAMFRAME_FEATURES)


_MODEL_TEXT = ["player_side", "player_role", "player_position", "player_to_predict", "player_weight", "absolute_yardline_number", "num_frames_output"]
_MODEL_DOUBLES = [c for c in PLAYER_COLUMNS if c not in [*ROW_KEYS, *_MODEL_TEXT]]


@query(
    "model_table",
    f"""SELECT {K4}, {", ".join(_MODEL_TEXT)}, {same(*_MODEL_DOUBLES)},
      {q(*[f"coalesce({c}, 0) AS {c}" for c in TEAMFRAME_FEATURES])}
    FROM scalars LEFT JOIN teamframe USING ({KF}, player_side)""",
    (*X.PLAYERS, *X.TEAMFRAME[1:]),
)
def _(spark, sf):
    players, teamframe, _ = P.feature_tables(tracking(spark, sf))
    return P.model_table(players, teamframe).select(*ROW_KEYS, *_MODEL_TEXT, *_MODEL_DOUBLES, *TEAMFRAME_FEATURES)


@query(
    "first_frame_per_side",
    f"SELECT {K4}, player_side, {same('x_norm')} FROM first_rows",
    ("norm", "first_rows"),
)
def _(spark, sf):
    first = rollups.frames_at_edge(rightward(tracking(spark, sf)), "first")
    return first.select(*ROW_KEYS, "player_side", "x_norm")


@query(
    "last_frame_per_side",
    f"SELECT {K4}, player_side, {same('x_norm')} FROM ({X._LAST.format(t='norm')})",
    NORM,
)
def _(spark, sf):
    last = rollups.frames_at_edge(rightward(tracking(spark, sf)), "last")
    return last.select(*ROW_KEYS, "player_side", "x_norm")


@query(
    "last_k_frames",
    f"""SELECT {K4}, player_side FROM (SELECT *, max(frame_id) OVER (PARTITION BY {KS}) AS top
      FROM tracking) WHERE frame_id >= top - 2""",
)
def _(spark, sf):
    return rollups.last_k_frames(tracking(spark, sf), 3).select(*ROW_KEYS, "player_side")


@query(
    "full_join_plays",
    # Label plays are numbered one on, so that either side has plays the other lacks.
    """SELECT game_id, play_id, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_labels AS BIGINT) AS n_labels
    FROM (SELECT game_id, play_id, count(*) AS n_rows FROM tracking GROUP BY 1, 2)
    FULL JOIN (SELECT game_id, play_id + 1 AS play_id, count(*) AS n_labels FROM labels GROUP BY 1, 2)
    USING (game_id, play_id)""",
)
def _(spark, sf):
    rows = tracking(spark, sf).groupBy(*PLAY_KEYS)
    moved = labels(spark, sf).withColumn("play_id", F.col("play_id") + 1).groupBy(*PLAY_KEYS)
    return joins.full_join_plays(
        rows.agg(F.count(F.lit(1)).alias("n_rows")), moved.agg(F.count(F.lit(1)).alias("n_labels"))
    )


@query(
    "labelled_players_only",
    f"SELECT {K4} FROM tracking WHERE nfl_id IN (SELECT nfl_id FROM labels)",
)
def _(spark, sf):
    return joins.only_labelled_players(tracking(spark, sf), labels(spark, sf)).select(*ROW_KEYS)


@query(
    "predictions_with_truth",
    f"SELECT {K4}, {same('x_pred', 'y_pred', 'x_true', 'y_true')} FROM matched",
    X.MATCHED,
)
def _(spark, sf):
    from gridmotion.catalog.modelling import matched_projection

    return matched_projection(spark, sf)


_INDEX_SQL = """WITH ids AS (SELECT nfl_id FROM labels GROUP BY 1),
  idx AS (SELECT nfl_id, row_number() OVER (ORDER BY nfl_id) - 1 AS player_idx FROM ids)"""


def _labelled_players(spark, sf):
    return P.player_index(labels(spark, sf))


@query(
    "player_index_known_only",
    f"{_INDEX_SQL} SELECT {K4}, player_idx FROM tracking JOIN idx USING (nfl_id)",
)
def _(spark, sf):
    out = joins.with_player_index(tracking(spark, sf), _labelled_players(spark, sf), "skip")
    return out.select(*ROW_KEYS, "player_idx")


@query(
    "player_index_unknown_zero",
    f"{_INDEX_SQL} SELECT {K4}, coalesce(player_idx, 0) AS player_idx FROM tracking LEFT JOIN idx USING (nfl_id)",
)
def _(spark, sf):
    out = joins.with_player_index(tracking(spark, sf), _labelled_players(spark, sf), "zero")
    return out.select(*ROW_KEYS, "player_idx")


@query(
    "player_index",
    """SELECT nfl_id, row_number() OVER (ORDER BY nfl_id) - 1 AS player_idx
    FROM (SELECT nfl_id FROM tracking UNION SELECT nfl_id FROM labels)""",
)
def _(spark, sf):
    return P.player_index(tracking(spark, sf), labels(spark, sf))


@query(
    "group_index",
    f"""SELECT {KS}, row_number() OVER (ORDER BY {KS}) - 1 AS idx
    FROM (SELECT DISTINCT {KS} FROM tracking)""",
)
def _(spark, sf):
    return skew.dense_index(rollups.distinct_keys(tracking(spark, sf), SIDE_KEYS), SIDE_KEYS)


_P90 = """SELECT nfl_id, max(a) FILTER (WHERE rn = CAST(round(0.9e0 * (n - 1)) AS BIGINT) + 1) AS p90
  FROM (SELECT nfl_id, a, row_number() OVER (PARTITION BY nfl_id ORDER BY a) AS rn,
    count(*) OVER (PARTITION BY nfl_id) AS n FROM tracking WHERE a IS NOT NULL) GROUP BY nfl_id"""


@query(
    "peak_acceleration_join",
    f"SELECT {K3}, {same('x', 'y', 'p90')} FROM last_rows LEFT JOIN ({_P90}) USING (nfl_id)",
    ("last_rows",),
)
def _(spark, sf):
    rows = tracking(spark, sf)
    peaks = rollups.exact_quantile(rows, ["nfl_id"], "a", 0.9, "p90")
    out = joins.with_peak_acceleration(rollups.last_states(rows), peaks)
    return out.select(*TIMELINE_KEYS, "x", "y", "p90")


# ------------------------------------------------------------------ aggregations


@query(
    "quantile_summaries",
    f"""SELECT nfl_id, CAST(count(a) AS BIGINT) AS n_values, true AS holds_exact
      FROM tracking WHERE a IS NOT NULL GROUP BY nfl_id""",
)
def _(spark, sf):
    """Summaries by player and week, merged by player: the interval holds the exact quantile."""
    weekly = summaries.quantile_summaries(tracking(spark, sf), ["nfl_id", "week"], "a")
    merged = summaries.summarized_quantile(summaries.merge_summaries(weekly, ["nfl_id"]), 0.9, "p90")
    exact = rollups.exact_quantile(tracking(spark, sf), ["nfl_id"], "a", 0.9, "exact")
    inside = F.col("exact").between(F.col("p90_low"), F.col("p90_high"))
    return merged.join(exact, "nfl_id").select("nfl_id", "n_values", inside.alias("holds_exact"))


@query("exact_quantile", f"SELECT nfl_id, {same('p90')} FROM ({_P90})")
def _(spark, sf):
    return rollups.exact_quantile(tracking(spark, sf), ["nfl_id"], "a", 0.9, "p90")


@query("last_state_per_timeline", f"SELECT {K4}, {same('x', 'y', 's')} FROM last_rows", ("last_rows",))
def _(spark, sf):
    return rollups.last_states(tracking(spark, sf)).select(*ROW_KEYS, "x", "y", "s")


@query(
    "last_known_value",
    f"""SELECT {K3}, {q("arg_max(x, frame_id) FILTER (WHERE x IS NOT NULL) AS last_x",
      "arg_max(y, frame_id) FILTER (WHERE y IS NOT NULL) AS last_s")}
    FROM (SELECT {K4}, x, s AS y FROM tracking) GROUP BY {K3}""",
)
def _(spark, sf):
    rows = tracking(spark, sf).select(*ROW_KEYS, "x", F.col("s").alias("y"))
    return rollups.last_known_position(rows, names=("last_x", "last_s"))


_TARGETS = ["width_x", "width_y", "center_x", "center_y", "mean_dist_to_center"]


@query(
    "formation_targets",
    f"""WITH c AS (SELECT {KF}, player_side, max(x_norm) - min(x_norm) AS width_x,
        max(y_norm) - min(y_norm) AS width_y, avg(x_norm) AS center_x, avg(y_norm) AS center_y
        FROM norm GROUP BY ALL)
    SELECT {KF}, player_side, {q(*[f"max({t}) AS {t}" for t in _TARGETS[:4]],
      "avg(sqrt((x_norm - center_x) * (x_norm - center_x) + (y_norm - center_y) * (y_norm - center_y))) AS mean_dist_to_center")}
    FROM norm JOIN c USING ({KF}, player_side) GROUP BY {KF}, player_side""",
    NORM,
)
def _(spark, sf):
    return rollups.formation_targets(rightward(tracking(spark, sf)))


_MOMENTS = ["x", "y", "s", "a", "dir", "o"]


@query(
    "feature_moments",
    "SELECT "
    + q(*[f"avg({c}) AS {c}_mean" for c in _MOMENTS], *[f"stddev_samp({c}) AS {c}_std" for c in _MOMENTS])
    + " FROM tracking",
)
def _(spark, sf):
    return column_moments(tracking(spark, sf), _MOMENTS)


@query(
    "target_moments",
    f"""SELECT {q(*[f"avg({c}) AS {c}_mean" for c in ("tx", "ty")], *[f"stddev_pop({c}) AS {c}_std" for c in ("tx", "ty")])}
    FROM tracking LEFT JOIN ({_LAST_LABEL}) USING ({K3})""",
)
def _(spark, sf):
    joined = joins.with_last_label(tracking(spark, sf), labels(spark, sf))
    return column_moments(joined, ["tx", "ty"], sample=False)


@query(
    "last_frame_means",
    f"SELECT {KS}, {same(*X.MEAN_NAMES)} FROM last_means",
    ("norm", "last_means"),
)
def _(spark, sf):
    return rollups.last_frame_means(rightward(tracking(spark, sf)))


@query(
    "pivot_sides",
    f"""SELECT game_id, play_id, {same(*[f"{v}_{s}" for v in X.MEAN_NAMES for s in ("Offense", "Defense")])}
    FROM ({X.pivoted(X.MEAN_NAMES, "last_means")})""",
    ("norm", "last_means"),
)
def _(spark, sf):
    means = rollups.last_frame_means(rightward(tracking(spark, sf)))
    return rollups.pivot_sides(means, X.MEAN_NAMES)


@query("distinct_plays", "SELECT DISTINCT game_id, play_id FROM tracking")
def _(spark, sf):
    return rollups.distinct_keys(tracking(spark, sf), PLAY_KEYS)


@query("distinct_players", "SELECT nfl_id FROM tracking UNION SELECT nfl_id FROM labels")
def _(spark, sf):
    return rollups.distinct_players(tracking(spark, sf), labels(spark, sf))


_POOL = """SELECT label, pos - 1 AS pos, {agg} AS value FROM (SELECT label, vec_id,
  unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings {where})
  GROUP BY label, pos"""


def _pooled(how, mask=None):
    def run(spark, sf):
        rows = table(spark, sf, "embeddings").withColumn("keep", F.col("embedding")[0] > 0)
        pooled = rollups.pool_vectors(rows, ["label"], "embedding", 64, how, mask)
        return pooled.select("label", F.posexplode("embedding").alias("pos", "value"))

    return run


for _how, _agg in (("mean", "avg(v)"), ("sum", "sum(v)"), ("max", "max(v)")):
    query(
        f"pool_vectors_{_how}",
        f"SELECT CAST(label AS BIGINT) AS label, CAST(pos AS BIGINT) AS pos, {same('value')}"
        f" FROM ({_POOL.format(agg=_agg, where='')})",
    )(_pooled(_how))

query(
    "pool_vectors_masked",
    f"SELECT CAST(label AS BIGINT) AS label, CAST(pos AS BIGINT) AS pos, {same('value')}"
    f" FROM ({_POOL.format(agg='avg(v)', where='WHERE embedding[1] > 0')})",
)(_pooled("mean", "keep"))


@query(
    "formation_sizes",
    f"SELECT {KF}, player_side, CAST(count(*) AS BIGINT) AS n_players FROM tracking GROUP BY ALL",
)
def _(spark, sf):
    return rollups.formation_sizes(tracking(spark, sf), SIDE_FRAME_KEYS)


# ------------------------------------------------------------------ sets


@query(
    "union_relaxed",
    f"SELECT {K4}, {same('x', 'y')} FROM tracking UNION ALL SELECT {K4}, {same('x', 'y')} FROM labels",
)
def _(spark, sf):
    columns = [*ROW_KEYS, "x", "y"]
    first = tracking(spark, sf).select(*columns)
    second = labels(spark, sf).select(*columns).withColumn("frame_id", F.col("frame_id").cast("bigint"))
    return union_all([first, second], first.schema)


@query(
    "union_strict",
    f"SELECT {K4} FROM tracking WHERE week % 2 = 0 UNION ALL SELECT {K4} FROM tracking WHERE week % 2 = 1",
)
def _(spark, sf):
    rows = tracking(spark, sf)
    return union_strict(
        [rows.where(f"week % 2 = {r}").select(*ROW_KEYS) for r in (0, 1)]
    )


# ------------------------------------------------------------------ samples and splits


def digest_sql(keys: list[str]) -> str:
    return "md5(concat_ws('#', '42', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + "))"


def number_sql(keys: list[str]) -> str:
    return f"CAST('0x' || substr({digest_sql(keys)}, 1, 8) AS BIGINT)"


_SAMPLE = f"""SELECT {K3} FROM (SELECT DISTINCT {K3} FROM labels)
  ORDER BY {digest_sql(TIMELINE_KEYS)}, {K3} LIMIT 30"""


@query("sample_keys", _SAMPLE)
def _(spark, sf):
    return sampling.sample_keys(labels(spark, sf), 30)


@query(
    "sample_sequences",
    f"SELECT {K4}, {same('x', 'y')} FROM labels JOIN ({_SAMPLE}) USING ({K3})",
)
def _(spark, sf):
    return sampling.sample_sequences(labels(spark, sf), 30).select(*ROW_KEYS, "x", "y")


def fraction_sql(keys: list[str]) -> str:
    """The digest of the keys as a fraction in [0, 1)."""
    return f"{number_sql(keys)} / 4294967296e0"


_FRACTION = fraction_sql(PLAY_KEYS)


@query(
    "split_train_val_test",
    f"""SELECT {K4}, CASE WHEN u < 0.7e0 THEN 'train' WHEN u < 0.85e0 THEN 'val' ELSE 'test' END AS split
    FROM (SELECT *, {_FRACTION} AS u FROM tracking)""",
)
def _(spark, sf):
    return sampling.train_val_test(tracking(spark, sf)).select(*ROW_KEYS, "split")


@query(
    "split_train_test",
    f"SELECT {K4}, CASE WHEN {_FRACTION} < 0.8e0 THEN 'train' ELSE 'test' END AS split FROM tracking",
)
def _(spark, sf):
    return sampling.train_test(tracking(spark, sf)).select(*ROW_KEYS, "split")


@query(
    "fold_assignment",
    f"SELECT {K4}, {number_sql(TIMELINE_KEYS)} % 3 AS fold FROM tracking",
)
def _(spark, sf):
    return sampling.fold_column(tracking(spark, sf), 3).select(*ROW_KEYS, "fold")
