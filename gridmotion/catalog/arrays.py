"""Queries over sequences, padded sets and formation vectors, flattened to rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmotion.catalog import sqltext as X
from gridmotion.catalog.base import labels, q, query, tracking
from gridmotion.catalog.features import K4, same
from gridmotion.operators import sequences as Q
from gridmotion.operators.joins import frame_aligned_join, with_last_label
from gridmotion.operators.rollups import TARGET_NAMES, formation_targets
from gridmotion.operators.normalize import fit_scaler, missing_to_zero, player_scalars, rightward
from gridmotion.plans import tables as P
from gridmotion.schemas import RAW_SEQUENCE_FEATURES, SIDE_FRAME_KEYS, SIDE_KEYS, TIMELINE_KEYS

K3 = "game_id, play_id, nfl_id"
KS = "game_id, play_id, player_side"


def cells(df, keys: list[str], array: str):
    """(keys, pos, feature, value) from an array of arrays."""
    rows = df.select(*keys, F.posexplode(array).alias("pos", "row"))
    return rows.select(*keys, "pos", F.posexplode("row").alias("feature", "value"))


def _padded(source: str, features: list[str], length: int, keep: str, pad: str, where: str = "") -> str:
    """SQL of the flattened form: real steps from source, zeros around them."""
    direction = "" if keep == "first" else "DESC"
    real = f"""SELECT *, row_number() OVER (PARTITION BY {K3} ORDER BY frame_id {direction}) AS rn
      FROM {source}"""
    kept = f"""SELECT *, count(*) OVER (PARTITION BY {K3}) AS n,
      row_number() OVER (PARTITION BY {K3} ORDER BY frame_id) - 1 AS step
      FROM ({real}) WHERE rn <= {length}"""
    shift = f"{length} - n + step" if pad == "left" else "step"
    values = " UNION ALL ".join(
        f"SELECT {K3}, CAST({shift} AS BIGINT) AS pos, CAST({i} AS BIGINT) AS feature, CAST({f} AS DOUBLE) AS value FROM kept"
        for i, f in enumerate(features)
    )
    return f"""WITH kept AS ({kept}), real_cells AS ({values}),
      grid AS (SELECT {K3}, p.pos, f.feature FROM (SELECT DISTINCT {K3} FROM kept),
        (SELECT CAST(range AS BIGINT) AS pos FROM range({length})) p,
        (SELECT CAST(range AS BIGINT) AS feature FROM range({len(features)})) f)
      SELECT {K3}, g.pos, g.feature, {q("CASE WHEN r.pos IS NULL THEN 0e0 ELSE r.value END AS value")}
      FROM grid g LEFT JOIN real_cells r USING ({K3}, pos, feature) {where}"""


_JOINED = f"""(SELECT {K3}, frame_id, s, a, dir, o, l.x / 120e0 AS lx, l.y / 53.3e0 AS ly
  FROM tracking t JOIN labels l USING ({K4}) WHERE t.player_to_predict)"""


def _label_sequences(spark, sf):
    joined = frame_aligned_join(tracking(spark, sf), labels(spark, sf))
    return Q.label_sequences(joined, length=10)


@query("label_sequences_features", _padded(_JOINED, ["s", "a", "dir", "o"], 10, "first", "right"))
def _(spark, sf):
    return cells(_label_sequences(spark, sf), TIMELINE_KEYS, "features")


@query("label_sequences_labels", _padded(_JOINED, ["lx", "ly"], 10, "first", "right"))
def _(spark, sf):
    return cells(_label_sequences(spark, sf), TIMELINE_KEYS, "labels")


_FILLED = [f"coalesce({c}, 0) AS {c}" for c in RAW_SEQUENCE_FEATURES]
_TARGETS = f"""SELECT {K3}, arg_max(x, frame_id) AS tx, arg_max(y, frame_id) AS ty
  FROM labels GROUP BY {K3}"""
_SCALED = f"""(SELECT {K3}, frame_id, {", ".join(
    f"({c} - (SELECT avg({c}) FROM filled)) / (SELECT greatest(stddev_samp({c}), 1e-6) FROM filled) AS {c}"
    for c in RAW_SEQUENCE_FEATURES)} FROM filled
  WHERE ({K3}) IN (SELECT ({K3}) FROM labels))"""
_FILLED_CTE = f"filled AS (SELECT {K4}, {', '.join(_FILLED)} FROM tracking)"


@query(
    "zscored_sequences",
    _padded(_SCALED, RAW_SEQUENCE_FEATURES, 15, "last", "left").replace(
        "WITH kept", f"WITH {_FILLED_CTE}, kept", 1
    ),
)
def _(spark, sf):
    rows = missing_to_zero(tracking(spark, sf), RAW_SEQUENCE_FEATURES)
    joined = with_last_label(rows, labels(spark, sf))
    scaler = fit_scaler(joined, RAW_SEQUENCE_FEATURES)
    return cells(Q.scaled_sequences(joined, scaler, 15), TIMELINE_KEYS, "features")


_SCALED_TARGET = """SELECT game_id, play_id, nfl_id, {tx}, {ty}, coalesce(player_idx, 0) AS player_idx
  FROM targets LEFT JOIN (SELECT nfl_id, row_number() OVER (ORDER BY nfl_id) - 1 AS player_idx FROM (
    SELECT DISTINCT nfl_id FROM tracking WHERE nfl_id % 2 = 0)) USING (nfl_id)"""


def _target_moments(column: str) -> str:
    """A target scaled over the input rows that carry it, by the population deviation."""
    rows = f"(SELECT {column} FROM tracking JOIN targets USING (game_id, play_id, nfl_id))"
    return q(
        f"({column} - (SELECT avg({column}) FROM {rows})) / (SELECT stddev_pop({column}) FROM {rows}) AS {column}"
    )


def _zscored(spark, sf, with_target: bool):
    rows = missing_to_zero(tracking(spark, sf), RAW_SEQUENCE_FEATURES)
    index = P.player_index(tracking(spark, sf).where("nfl_id % 2 = 0"))
    if not with_target:
        return Q.scaled_sequences(rows, fit_scaler(rows, RAW_SEQUENCE_FEATURES), 15, None, player_index=index)
    joined = with_last_label(rows, labels(spark, sf))
    scaler = fit_scaler(joined, RAW_SEQUENCE_FEATURES)
    targets = fit_scaler(joined, ["tx", "ty"], sample=False)
    return Q.scaled_sequences(joined, scaler, 15, target_scaler=targets, player_index=index)


@query(
    "zscored_sequence_targets",
    f"WITH targets AS ({_TARGETS}) "
    + _SCALED_TARGET.format(tx=_target_moments("tx"), ty=_target_moments("ty")),
)
def _(spark, sf):
    """Scaled targets and player indexes; every second player is known to the index."""
    packed = _zscored(spark, sf, True)
    return packed.select(
        *TIMELINE_KEYS, F.col("target")[0].alias("tx"), F.col("target")[1].alias("ty"), "player_idx"
    )


@query(
    "zscored_sequences_inference",
    _padded(_SCALED.replace(f"WHERE ({K3}) IN (SELECT ({K3}) FROM labels)", ""), RAW_SEQUENCE_FEATURES, 15, "last", "left")
    .replace("WITH kept", f"WITH {_FILLED_CTE}, kept", 1),
)
def _(spark, sf):
    """Every timeline, labelled or not, as a model meets it when it predicts."""
    return cells(_zscored(spark, sf, False), TIMELINE_KEYS, "features")


_PLAY_FEATURES = ["x_norm", "y_norm", "s", "a", "vx", "vy"]
_MODEL = f"""(SELECT {K4}, x_norm, y_norm, coalesce(s, 0e0) AS s, a,
  coalesce(s * cos(radians(dir_norm)), 0e0) AS vx, coalesce(s * sin(radians(dir_norm)), 0e0) AS vy
  FROM norm)"""


def _model_rows(spark, sf):
    return player_scalars(rightward(tracking(spark, sf)))


@query("play_sequences", _padded(_MODEL, _PLAY_FEATURES, 15, "last", "left"), ("norm",))
def _(spark, sf):
    packed = Q.play_sequences(
        _model_rows(spark, sf), _PLAY_FEATURES, ["ball_land_x", "ball_land_y"], 15
    )
    return cells(packed, TIMELINE_KEYS, "features")


@query(
    "play_sequence_targets",
    f"SELECT {K3}, {q('ball_land_x AS target_x', 'ball_land_y AS target_y')} FROM last_rows",
    ("last_rows",),
)
def _(spark, sf):
    packed = Q.play_sequences(
        _model_rows(spark, sf), _PLAY_FEATURES, ["ball_land_x", "ball_land_y"], 15
    )
    return packed.select(
        *TIMELINE_KEYS, F.col("target")[0].alias("target_x"), F.col("target")[1].alias("target_y")
    )


_LONG_ENOUGH = f"""(SELECT * FROM {_MODEL} WHERE ({K3}) IN (SELECT ({K3}) FROM norm
  GROUP BY {K3} HAVING count(*) >= 12))"""


@query("frame_sequences", _padded(_LONG_ENOUGH, _PLAY_FEATURES, 12, "last", "left"), ("norm",))
def _(spark, sf):
    packed = Q.frame_sequences(_model_rows(spark, sf), _PLAY_FEATURES, 12)
    return cells(packed, TIMELINE_KEYS, "features")


@query("frame_sequence_targets", _padded(_LONG_ENOUGH, ["x_norm", "y_norm"], 12, "last", "left"), ("norm",))
def _(spark, sf):
    packed = Q.frame_sequences(_model_rows(spark, sf), _PLAY_FEATURES, 12)
    return cells(packed, TIMELINE_KEYS, "targets")


@query(
    "frame_sequence_steps",
    f"""SELECT {K3}, frame_id, CAST(rn - 1 AS BIGINT) AS pos, {same("x_norm", "y_norm")} FROM (SELECT *,
      count(*) OVER (PARTITION BY {K3}) AS n, row_number() OVER (PARTITION BY {K3} ORDER BY frame_id) AS rn,
      row_number() OVER (PARTITION BY {K3} ORDER BY frame_id DESC) AS back FROM norm)
    WHERE n >= 8 AND back <= 8""".replace("rn - 1", "8 - back"),
    ("norm",),
)
def _(spark, sf):
    packed = Q.frame_sequences(rightward(tracking(spark, sf)), ["x_norm", "y_norm"], 8, with_targets=False)
    zipped = F.arrays_zip("steps", "features")
    rows = packed.select(*TIMELINE_KEYS, F.posexplode(zipped).alias("pos", "e"))
    return rows.select(
        *TIMELINE_KEYS,
        F.col("e.steps").alias("frame_id"),
        "pos",
        F.col("e.features")[0].alias("x_norm"),
        F.col("e.features")[1].alias("y_norm"),
    )


@query(
    "unpack_sequences",
    f"""SELECT {K4}, {q("x_norm AS pred_x", "y_norm AS pred_y")} FROM (SELECT *,
      count(*) OVER (PARTITION BY {K3}) AS n, row_number() OVER (PARTITION BY {K3} ORDER BY frame_id DESC) AS back
      FROM norm) WHERE n >= 8 AND back <= 8""",
    ("norm",),
)
def _(spark, sf):
    packed = Q.frame_sequences(rightward(tracking(spark, sf)), ["x_norm", "y_norm"], 8)
    return Q.unpack_sequences(packed, values="features")


def _vector_sql(source: str, side: str) -> str:
    return f"""WITH placed AS (SELECT {KS}, x_norm, y_norm, count(*) OVER (PARTITION BY {KS}) AS n_players,
        row_number() OVER (PARTITION BY {KS} ORDER BY y_norm, x_norm) AS rn FROM {source} {side}),
      grid AS (SELECT {KS}, n_players, p.rn FROM (SELECT DISTINCT {KS}, n_players FROM placed),
        (SELECT range + 1 AS rn FROM range(11)) p)
    SELECT {KS}, CAST(n_players AS BIGINT) AS n_players, CAST(rn - 1 AS BIGINT) AS slot,
      {q("coalesce(x_norm, 0e0) AS x", "coalesce(y_norm, 0e0) AS y")}
    FROM grid LEFT JOIN (SELECT {KS}, rn, x_norm, y_norm FROM placed) USING ({KS}, rn)"""


def _slots(df):
    pairs = F.transform(
        F.sequence(F.lit(0), F.lit(10)),
        lambda i: F.struct(
            i.alias("slot"),
            F.get("vector", i * 2).alias("x"),
            F.get("vector", i * 2 + 1).alias("y"),
        ),
    )
    return df.select(*SIDE_KEYS, "n_players", F.inline(pairs))


@query(
    "formation_vectors_first",
    _vector_sql("first_rows", "WHERE player_side = 'Offense'"),
    ("norm", "first_rows"),
)
def _(spark, sf):
    return _slots(Q.formation_vectors(rightward(tracking(spark, sf)), "Offense"))


@query(
    "formation_vectors_last",
    _vector_sql(f"({X._LAST.format(t='norm')})", ""),
    ("norm",),
)
def _(spark, sf):
    return _slots(Q.formation_vectors(rightward(tracking(spark, sf)), None, frame_policy="last"))


_MATRIX_NAMES = ["width_x", "width_y", "center_x", "center_y", "mean_dist_to_center"]


@query("formation_matrix", f"SELECT {KS}, {same(*_MATRIX_NAMES)} FROM matrix", X.MATRIX)
def _(spark, sf):
    return Q.formation_matrix(rightward(tracking(spark, sf))).select(*SIDE_KEYS, *_MATRIX_NAMES)


_KFS = "game_id, play_id, frame_id, player_side"
_SET_VALUES = ["x_norm", "y_norm", "s", "a"]
_SET_SQL = " UNION ALL ".join(
    f"""SELECT {_KFS}, CAST(rn - 1 AS BIGINT) AS pos, CAST({i} AS BIGINT) AS feature, {v} AS value FROM placed"""
    for i, v in enumerate(
        [
            *_SET_VALUES,
            "sin(radians(dir_norm))",
            "cos(radians(dir_norm))",
            "sin(radians(o_norm))",
            "cos(radians(o_norm))",
        ]
    )
)


@query(
    "player_sets",
    f"""WITH placed AS (SELECT *, row_number() OVER (PARTITION BY {_KFS} ORDER BY x_norm, y_norm) AS rn FROM norm),
      filled AS ({_SET_SQL}),
      grid AS (SELECT {_KFS}, p.pos, f.feature FROM (SELECT DISTINCT {_KFS} FROM norm),
        (SELECT CAST(range AS BIGINT) AS pos FROM range(12)) p,
        (SELECT CAST(range AS BIGINT) AS feature FROM range(8)) f)
    SELECT {_KFS}, g.pos, g.feature, {q("CASE WHEN v.pos IS NULL THEN 0e0 ELSE v.value END AS value")}
    FROM grid g LEFT JOIN filled v USING ({_KFS}, pos, feature)""",
    ("norm",),
)
def _(spark, sf):
    return cells(Q.player_sets(tracking(spark, sf), n_max=12), SIDE_FRAME_KEYS, "features")


@query(
    "player_set_masks",
    f"""WITH n AS (SELECT {_KFS}, count(*) AS n FROM norm GROUP BY ALL)
    SELECT {_KFS}, CAST(range AS BIGINT) AS pos, CASE WHEN range < n THEN 1e0 ELSE 0e0 END AS value
    FROM n, range(12)""",
    ("norm",),
)
def _(spark, sf):
    sets = Q.player_sets(tracking(spark, sf), n_max=12)
    return sets.select(*SIDE_FRAME_KEYS, F.posexplode("mask").alias("pos", "value"))


_GROUP = f"OVER (PARTITION BY {_KFS})"
_TARGETS_SQL = f"""SELECT {_KFS}, max(width_x) AS width_x, max(width_y) AS width_y, max(center_x) AS center_x,
  max(center_y) AS center_y, avg(sqrt((x_norm - center_x) * (x_norm - center_x)
    + (y_norm - center_y) * (y_norm - center_y))) AS mean_dist_to_center
  FROM (SELECT {_KFS}, x_norm, y_norm, max(x_norm) {_GROUP} - min(x_norm) {_GROUP} AS width_x,
    max(y_norm) {_GROUP} - min(y_norm) {_GROUP} AS width_y, avg(x_norm) {_GROUP} AS center_x,
    avg(y_norm) {_GROUP} AS center_y FROM {{rows}}) GROUP BY {_KFS}"""


@query(
    "player_set_targets",
    f"SELECT {_KFS}, {same(*TARGET_NAMES)} FROM ({_TARGETS_SQL.format(rows='norm')})",
    ("norm",),
)
def _(spark, sf):
    sets = Q.player_sets(tracking(spark, sf), n_max=12)
    picks = [F.col("targets")[i].alias(n) for i, n in enumerate(TARGET_NAMES)]
    return sets.select(*SIDE_FRAME_KEYS, *picks)


@query(
    "formation_targets_null_side",
    f"""WITH sided AS (SELECT * REPLACE (CASE WHEN nfl_id % 3 = 0 THEN NULL ELSE player_side END AS player_side)
      FROM norm) SELECT {_KFS}, {same(*TARGET_NAMES)} FROM ({_TARGETS_SQL.format(rows='sided')})""",
    ("norm",),
)
def _(spark, sf):
    sided = F.when(F.col("nfl_id") % 3 != 0, F.col("player_side"))
    rows = rightward(tracking(spark, sf)).withColumn("player_side", sided)
    return formation_targets(rows)
