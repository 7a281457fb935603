"""Queries over scalars, time features, frame geometry and the feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmotion.catalog import sqltext as X
from gridmotion.catalog.base import labels, q, query, table, tracking
from gridmotion.functions import scalars as S
from gridmotion.operators import normalize as N
from gridmotion.operators import rollups, spatial, temporal
from gridmotion.plans import tables as P
from gridmotion.schemas import (
    FRAME_KEYS,
    PLAYER_COLUMNS,
    ROW_KEYS,
    SIDE_FRAME_KEYS,
    TEAMFRAME_FEATURES,
    TEMPORAL_COLUMNS,
)

K4 = "game_id, play_id, nfl_id, frame_id"
NORM = ("norm",)


def same(*names: str) -> str:
    return q(*[f"{n} AS {n}" for n in names])


# ------------------------------------------------------------------ scalars


@query("height_to_inches", f"SELECT {K4}, {q(f'{X.HEIGHT} AS height_in')} FROM tracking")
def _(spark, sf):
    return tracking(spark, sf).select(
        *ROW_KEYS, S.height_to_inches(F.col("player_height")).alias("height_in")
    )


@query("age_years", f"SELECT {K4}, {q(f'{X.AGE} AS player_age')} FROM tracking")
def _(spark, sf):
    return tracking(spark, sf).select(
        *ROW_KEYS, S.age_years(F.col("player_birth_date")).alias("player_age")
    )


@query(
    "bmi",
    f"SELECT {K4}, {q(f'{X.BMI} AS player_bmi')} FROM (SELECT *, {X.HEIGHT} AS height_in FROM tracking)",
)
def _(spark, sf):
    height = S.height_to_inches(F.col("player_height"))
    return tracking(spark, sf).select(
        *ROW_KEYS, S.bmi(F.col("player_weight"), height).alias("player_bmi")
    )


@query(
    "angle_functions",
    f"""SELECT {K4}, {q("radians(dir) AS dir_rad", f"{X.floored_mod('dir - 500e0')} AS wrapped",
        "sin(radians(o)) AS o_sin", "cos(radians(o)) AS o_cos")} FROM tracking""",
)
def _(spark, sf):
    return tracking(spark, sf).select(
        *ROW_KEYS,
        S.deg_to_rad(F.col("dir")).alias("dir_rad"),
        S.wrap_degrees(F.col("dir") - 500.0).alias("wrapped"),
        S.sin_deg(F.col("o")).alias("o_sin"),
        S.cos_deg(F.col("o")).alias("o_cos"),
    )


@query(
    "velocity_components",
    f"""SELECT {K4}, {q("s * cos(radians(dir)) AS vx", "s * sin(radians(dir)) AS vy",
        "s * sin(radians(dir)) AS vx_compass", "s * cos(radians(dir)) AS vy_compass")}
    FROM tracking""",
)
def _(spark, sf):
    vx, vy = S.heading_components(F.col("s"), F.col("dir"))
    cx, cy = S.heading_components(F.col("s"), F.col("dir"), "compass")
    return tracking(spark, sf).select(
        *ROW_KEYS,
        vx.alias("vx"),
        vy.alias("vy"),
        cx.alias("vx_compass"),
        cy.alias("vy_compass"),
    )


@query(
    "acceleration_components",
    f"""SELECT {K4}, {q("a * cos(radians(dir)) AS ax", "a * sin(radians(dir)) AS ay")}
    FROM tracking""",
)
def _(spark, sf):
    ax, ay = S.heading_components(F.col("a"), F.col("dir"))
    return tracking(spark, sf).select(*ROW_KEYS, ax.alias("ax"), ay.alias("ay"))


@query(
    "ball_position",
    f"""SELECT {K4}, {q("CASE WHEN s IS NULL THEN CAST('NaN' AS DOUBLE) ELSE s + t * (ball_land_x - s) END AS ball_x",
        "CASE WHEN s IS NULL THEN CAST('NaN' AS DOUBLE) ELSE y + t * (ball_land_y - y) END AS ball_y")}
    FROM (SELECT *, least(1e0, frame_id / CAST(num_frames_output AS DOUBLE)) AS t FROM tracking)""",
)
def _(spark, sf):
    bx, by = S.ball_position(
        *[F.col(c) for c in ("s", "y", "ball_land_x", "ball_land_y", "frame_id", "num_frames_output")]
    )
    return tracking(spark, sf).select(*ROW_KEYS, bx.alias("ball_x"), by.alias("ball_y"))


@query(
    "distance_and_bearing",
    f"""SELECT {K4}, {q("sqrt((ball_land_x - x) * (ball_land_x - x) + (ball_land_y - y) * (ball_land_y - y)) AS distance",
        "atan2(ball_land_y - y, ball_land_x - x) AS bearing")} FROM tracking""",
)
def _(spark, sf):
    distance, bearing = S.distance_and_bearing(
        *[F.col(c) for c in ("x", "y", "ball_land_x", "ball_land_y")]
    )
    return tracking(spark, sf).select(
        *ROW_KEYS, distance.alias("distance"), bearing.alias("bearing")
    )


@query(
    "normalize_rightward_wrapped",
    f"""SELECT {K4}, {q("x_norm AS x_norm", "y_norm AS y_norm", f"{X.floored_mod('dir_norm')} AS dir_norm",
        f"{X.floored_mod('o_norm')} AS o_norm")} FROM norm""",
    NORM,
)
def _(spark, sf):
    return N.rightward(tracking(spark, sf), wrap=True).select(*ROW_KEYS, *N.NORM_COLUMNS)


@query("rightward_columns", f"SELECT {K4}, {same(*N.NORM_COLUMNS)} FROM norm", NORM)
def _(spark, sf):
    return N.rightward(tracking(spark, sf)).select(*ROW_KEYS, *N.NORM_COLUMNS)


@query(
    "ensure_rightward",
    f"""SELECT {K4}, {q("x AS x_norm", "y AS y_norm", "dir AS dir_norm", "o AS o_norm")}, 'kept' AS source
    FROM tracking UNION ALL SELECT {K4}, {same(*N.NORM_COLUMNS)}, 'derived' AS source FROM norm""",
    NORM,
)
def _(spark, sf):
    raw = tracking(spark, sf)
    kept = N.ensure_rightward(
        raw.withColumnsRenamed({c.removesuffix("_norm"): c for c in N.NORM_COLUMNS})
    )
    derived = N.ensure_rightward(raw)
    parts = [
        t.select(*ROW_KEYS, *N.NORM_COLUMNS, F.lit(source).alias("source"))
        for t, source in ((kept, "kept"), (derived, "derived"))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "label_scaling",
    f"""SELECT {K4}, {q("x / 120e0 AS x_scaled", "y / 53.3e0 AS y_scaled",
        "x / 120e0 * 120e0 AS x_yards", "y / 53.3e0 * 53.3e0 AS y_yards")} FROM labels""",
)
def _(spark, sf):
    scaled = N.scaled_labels(labels(spark, sf), "x", "y")
    return N.unscaled_labels(scaled).select(
        *ROW_KEYS, "x_scaled", "y_scaled", "x_yards", "y_yards"
    )


@query(
    "zscore_and_inverse",
    f"""WITH m AS (SELECT avg(s) AS ms, greatest(stddev_samp(s), 1e-6) AS ds, avg(a) AS ma,
      greatest(stddev_samp(a), 1e-6) AS da FROM tracking)
    SELECT {K4}, {q("(s - ms) / ds AS s_z", "(a - ma) / da AS a_z", "s AS s_back", "a AS a_back")}
    FROM tracking, m""",
)
def _(spark, sf):
    rows = tracking(spark, sf)
    scaler = N.fit_scaler(rows, ["s", "a"])
    scaled = scaler.transform(rows, suffix="_z")
    back = scaler.inverse(
        scaled.withColumns({"s_back": F.col("s_z"), "a_back": F.col("a_z")}),
        {"s_back": "s", "a_back": "a"},
    )
    return back.select(*ROW_KEYS, "s_z", "a_z", "s_back", "a_back")


def _spoiled(spark, sf):
    """Some values turned into NaN and infinity."""
    value = (
        F.when(F.col("frame_id") == 3, F.lit(float("nan")))
        .when(F.col("frame_id") == 4, F.lit(float("inf")))
        .when(F.col("frame_id") == 5, F.lit(float("-inf")))
        .otherwise(F.col("s"))
    )
    return tracking(spark, sf).withColumn("v", value)


_SPOILED = """(SELECT *, CASE frame_id WHEN 3 THEN CAST('NaN' AS DOUBLE)
  WHEN 4 THEN CAST('Infinity' AS DOUBLE) WHEN 5 THEN CAST('-Infinity' AS DOUBLE) ELSE s END AS v
  FROM tracking)"""


@query("null_to_zero", f"SELECT {K4}, {q('coalesce(s, 0e0) AS s')} FROM tracking")
def _(spark, sf):
    return N.null_to_zero(tracking(spark, sf), ["s"]).select(*ROW_KEYS, "s")


@query(
    "missing_to_zero",
    f"""SELECT {K4}, {q("CASE WHEN v IS NULL OR isnan(v) THEN 0e0 ELSE v END AS v")}
    FROM {_SPOILED}""",
)
def _(spark, sf):
    return N.missing_to_zero(_spoiled(spark, sf), ["v"]).select(*ROW_KEYS, "v")


@query(
    "not_finite_to_zero",
    f"""SELECT {K4}, {q("CASE WHEN v IS NULL OR NOT isfinite(v) THEN 0e0 ELSE v END AS v")}
    FROM {_SPOILED}""",
)
def _(spark, sf):
    return N.not_finite_to_zero(_spoiled(spark, sf), ["v"]).select(*ROW_KEYS, "v")


@query("side_filter", f"SELECT {K4}, player_side FROM tracking WHERE player_side = 'Defense'")
def _(spark, sf):
    return N.only_side(tracking(spark, sf), "Defense").select(*ROW_KEYS, "player_side")


@query(
    "side_filter_any_case",
    f"SELECT {K4}, player_side FROM tracking WHERE lower(player_side) = 'offense'",
)
def _(spark, sf):
    return N.only_side_any_case(tracking(spark, sf), "OFFENSE").select(*ROW_KEYS, "player_side")


@query("players_to_predict", f"SELECT {K4} FROM tracking WHERE player_to_predict")
def _(spark, sf):
    return N.to_predict(tracking(spark, sf)).select(*ROW_KEYS)


@query("one_play", f"SELECT {K4}, {same('x', 'y')} FROM tracking WHERE game_id = 2024000000 AND play_id = 3")
def _(spark, sf):
    return N.one_play(tracking(spark, sf), 2024000000, 3).select(*ROW_KEYS, "x", "y")


@query(
    "composite_key",
    """SELECT concat_ws('|', CAST(game_id AS VARCHAR), CAST(play_id AS VARCHAR),
      CAST(frame_id AS VARCHAR), CAST(nfl_id AS VARCHAR)) AS pk FROM tracking""",
)
def _(spark, sf):
    return N.composite_key(tracking(spark, sf), [*FRAME_KEYS, "nfl_id"]).select("pk")


@query(
    "error_columns",
    f"""SELECT {K4}, {q("x_pred - x_true AS dx", "y_pred - y_true AS dy", f"sqrt({X.SQ}) AS error")}
    FROM matched""",
    X.MATCHED,
)
def _(spark, sf):
    from gridmotion.catalog.modelling import matched_projection

    rows = matched_projection(spark, sf)
    out = N.error_columns(rows, ("x_pred", "y_pred"), ("x_true", "y_true"))
    return out.select(*ROW_KEYS, "dx", "dy", "error")


@query("present_columns", f"SELECT {K4}, player_side, {same('s', 'a')} FROM tracking")
def _(spark, sf):
    return N.present_columns(
        tracking(spark, sf), [*ROW_KEYS, "player_side", "s", "vx", "a", "cumulative_distance"]
    )


# ------------------------------------------------------------------ time features


def _timed(spark, sf):
    rows = N.rightward(tracking(spark, sf))
    return temporal.temporal_features(rows, direction="dir_norm", x="x_norm", y="y_norm")


for _name, _columns in {
    "rolling_mean_std": [c for c in TEMPORAL_COLUMNS if "rolling" in c],
    "angular_velocity": ["angular_velocity"],
    "position_deltas": ["delta_x", "delta_y"],
    "cumulative_distance": ["cumulative_distance"],
}.items():
    query(_name, f"SELECT {K4}, {same(*_columns)} FROM timed", X.TIMED)(
        lambda spark, sf, columns=_columns: _timed(spark, sf).select(*ROW_KEYS, *columns)
    )

_USER = "PARTITION BY user_id ORDER BY ts, event_id"


def _user_frame(size: int) -> str:
    return f"OVER ({_USER} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"


@query(
    "user_timeline_features",
    f"""WITH e AS (SELECT *, value - lag(value) OVER ({_USER}) AS step FROM events)
    SELECT user_id, event_id, {q(
        f"CASE WHEN count(value) {_user_frame(3)} = 3 THEN avg(value) {_user_frame(3)} END AS mean_3",
        f"CASE WHEN count(value) {_user_frame(5)} = 5 THEN stddev_samp(value) {_user_frame(5)} END AS std_5",
        "step AS delta_x",
        f"CASE WHEN step IS NOT NULL THEN sum(abs(step)) OVER ({_USER} ROWS UNBOUNDED PRECEDING) END AS path",
    )} FROM e""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    out = temporal.temporal_features(
        events.withColumn("level", F.lit(0.0)),
        keys=["user_id"],
        order=("ts", "event_id"),
        s="value",
        a="value",
        direction="value",
        x="value",
        y="level",
    )
    return out.select(
        "user_id",
        "event_id",
        F.col("speed_rolling_mean_3").alias("mean_3"),
        F.col("speed_rolling_std_5").alias("std_5"),
        "delta_x",
        F.col("cumulative_distance").alias("path"),
    )


_PRIORS = ", ".join(
    f"lag({c}, {k}) OVER (PARTITION BY game_id, play_id, nfl_id ORDER BY frame_id) AS {c}_prior{k}"
    for k in (1, 2, 3)
    for c in ("x", "y")
)
_PRIOR_NAMES = [f"{c}_prior{k}" for k in (1, 2, 3) for c in ("x", "y")]


@query(
    "prior_features",
    f"""SELECT {K4}, {same(*_PRIOR_NAMES)} FROM (SELECT {K4}, {_PRIORS} FROM tracking)
    WHERE x_prior3 IS NOT NULL AND y_prior3 IS NOT NULL""",
)
def _(spark, sf):
    return temporal.prior_features(tracking(spark, sf), 3).select(*ROW_KEYS, *_PRIOR_NAMES)


# ------------------------------------------------------------------ frame geometry

_SHAPE_NAMES = [
    "formation_width",
    "formation_depth",
    "formation_x_mean",
    "formation_y_mean",
    "distance_to_formation_center",
    "relative_formation_depth",
    "relative_formation_width",
]


@query("formation_features", f"SELECT {K4}, {same(*_SHAPE_NAMES)} FROM shaped", X.SHAPE)
def _(spark, sf):
    rows = N.rightward(tracking(spark, sf))
    return spatial.formation_features(rows, x="x_norm", y="y_norm").select(*ROW_KEYS, *_SHAPE_NAMES)


@query(
    "frame_neighbours",
    f"""SELECT {K4}, CAST(count(*) AS BIGINT) AS n_others,
      CAST(count(*) FILTER (WHERE same_side) AS BIGINT) AS n_same_side,
      {q("sum(dist) AS distance_sum", "max(dist) AS distance_max")} FROM pairs GROUP BY ALL""",
    ("norm", "pairs"),
)
def _(spark, sf):
    met = spatial.frame_neighbours(N.rightward(tracking(spark, sf)), x="x_norm", y="y_norm")
    far = F.transform("neighbours", lambda n: n["distance"])
    per_block = met.select(
        *ROW_KEYS,
        F.size("neighbours").alias("n"),
        F.size(F.filter("neighbours", lambda n: n["same_side"])).alias("n_same"),
        F.aggregate(far, F.lit(0.0), lambda acc, d: acc + d).alias("total"),
        F.array_max(far).alias("farthest"),
    )
    return (
        per_block.groupBy(*ROW_KEYS)
        .agg(
            F.sum("n").alias("n_others"),
            F.sum("n_same").alias("n_same_side"),
            F.sum("total").alias("distance_sum"),
            F.max("farthest").alias("distance_max"),
        )
        .where("n_others > 0")
    )


_NEAR = spatial.coverage_columns((3.0, 5.0, 7.0))
_NEAR_SQL = f"{same(*_NEAR[:3])}, {', '.join(_NEAR[3:])}"


@query("coverage_features", f"SELECT {K4}, {_NEAR_SQL} FROM covered", X.COVERAGE)
def _(spark, sf):
    rows = N.rightward(tracking(spark, sf)).select(*FRAME_KEYS, "player_side", "nfl_id", "x_norm", "y_norm")
    return spatial.coverage_features(rows, x="x_norm", y="y_norm").select(*ROW_KEYS, *_NEAR)


@query(
    "team_opponent_means",
    f"""WITH t AS (SELECT game_id, play_id, frame_id, player_side, sum(x_norm) AS sx, sum(y_norm) AS sy,
        count(*) AS n FROM norm GROUP BY 1, 2, 3, 4),
      f AS (SELECT *, sum(sx) OVER w - sx AS ox, sum(sy) OVER w - sy AS oy, sum(n) OVER w - n AS o_n
        FROM t WINDOW w AS (PARTITION BY game_id, play_id, frame_id))
    SELECT {K4}, {q("sx / n AS team_avg_x", "sy / n AS team_avg_y",
      "CASE WHEN o_n > 0 THEN ox / o_n ELSE CAST('NaN' AS DOUBLE) END AS opp_avg_x",
      "CASE WHEN o_n > 0 THEN oy / o_n ELSE CAST('NaN' AS DOUBLE) END AS opp_avg_y")}
    FROM norm JOIN f USING (game_id, play_id, frame_id, player_side)""",
    NORM,
)
def _(spark, sf):
    rows = N.rightward(tracking(spark, sf))
    return spatial.team_opponent_means(rows).select(
        *ROW_KEYS, "team_avg_x", "team_avg_y", "opp_avg_x", "opp_avg_y"
    )


@query(
    "play_state_score",
    f"""WITH o AS (SELECT game_id, play_id, frame_id, sum(-(CASE WHEN player_role = 'Targeted Receiver'
        THEN 50e0 ELSE 1e0 END) * sqrt((x - ball_land_x) * (x - ball_land_x)
        + (y - ball_land_y) * (y - ball_land_y))) FILTER (WHERE player_side = 'Offense') AS reach
        FROM tracking GROUP BY 1, 2, 3),
      c AS (SELECT l.game_id, l.play_id, l.frame_id, count(*) AS contacts FROM tracking l JOIN tracking r
        ON l.game_id = r.game_id AND l.play_id = r.play_id AND l.frame_id = r.frame_id
        AND l.player_side = 'Offense' AND r.player_side <> 'Offense'
        AND sqrt((l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y)) < 2e0 GROUP BY 1, 2, 3)
    SELECT game_id, play_id, frame_id, {q("coalesce(reach, 0e0) - 100e0 * coalesce(contacts, 0) AS score")}
    FROM o LEFT JOIN c USING (game_id, play_id, frame_id)""",
)
def _(spark, sf):
    return spatial.play_state_score(tracking(spark, sf))


# ------------------------------------------------------------------ feature tables

_TEXT = ["player_side", "player_role", "player_position", "player_to_predict"]
_INTS = ["player_weight", "absolute_yardline_number", "num_frames_output"]
_PLAYER_DOUBLES = [
    c for c in PLAYER_COLUMNS if c not in [*FRAME_KEYS, "nfl_id", *_TEXT, *_INTS]
]


@query(
    "player_scalars",
    f"""SELECT {K4}, {same("height_in", "player_age", "player_bmi", "dir_sin", "dir_cos", "o_sin",
      "o_cos", "vx", "vy", "ax", "ay")} FROM scalars""",
    X.PLAYERS,
)
def _(spark, sf):
    out = N.player_scalars(N.rightward(tracking(spark, sf)))
    return out.select(
        *ROW_KEYS,
        *"height_in player_age player_bmi dir_sin dir_cos o_sin o_cos vx vy ax ay".split(),
    )


@query(
    "players_table",
    f"SELECT {K4}, {', '.join(_TEXT + _INTS)}, {same(*_PLAYER_DOUBLES)} FROM scalars",
    X.PLAYERS,
)
def players(spark, sf):
    return P.players_table(tracking(spark, sf))


_TF_SQL = f"{same(*TEAMFRAME_FEATURES[:10])}, {', '.join(TEAMFRAME_FEATURES[10:])}"


@query(
    "teamframe_table",
    f"SELECT {', '.join(SIDE_FRAME_KEYS)}, {_TF_SQL} FROM teamframe",
    X.TEAMFRAME,
)
def teamframe(spark, sf):
    return P.teamframe_table(tracking(spark, sf))


_PLAY_NAMES = [f"{v}_{s}" for v in X.MEAN_NAMES + X.SHAPE_NAMES for s in ("Offense", "Defense")]


@query("plays_table", f"SELECT game_id, play_id, {same(*_PLAY_NAMES)} FROM plays", X.PLAYS)
def plays(spark, sf):
    return P.plays_from_tracking(tracking(spark, sf))


@query("plays_table_from_tables", f"SELECT game_id, play_id, {same(*_PLAY_NAMES)} FROM plays", X.PLAYS)
def _(spark, sf):
    players, teamframe, _ = P.feature_tables(tracking(spark, sf))
    return P.plays_table(players, teamframe)


@query(
    "side_shapes",
    f"""SELECT {', '.join(SIDE_FRAME_KEYS)}, {same("formation_width", "formation_depth",
      "formation_x_mean", "formation_y_mean")} FROM shape""",
    ("norm", "shape"),
)
def _(spark, sf):
    return spatial.side_shapes(N.rightward(tracking(spark, sf)), x="x_norm", y="y_norm")


def _values_sql(name: str, source: str, keys: list[str], values: list[str]) -> str:
    """(name, keys as text, column, value) of every value of a table."""
    key = "concat_ws('/', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")"
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, {key} AS key, '{v}' AS "column", {q(f"CAST({v} AS DOUBLE) AS value")} FROM {source}""" for v in values
    )


_TABLE_VALUES = {
    "players": ("scalars", ROW_KEYS, [*_INTS, *_PLAYER_DOUBLES]),
    "teamframe": ("teamframe", SIDE_FRAME_KEYS, TEAMFRAME_FEATURES),
    "plays": ("plays", ["game_id", "play_id"], _PLAY_NAMES),
}


@query(
    "feature_tables",
    " UNION ALL ".join(_values_sql(name, *parts) for name, parts in _TABLE_VALUES.items()),
    (*X.PLAYERS, *X.TEAMFRAME[1:], "last_means", "last_shape", "plays"),
)
def _(spark, sf):
    """Every number of the three tables, a row each."""
    out = None
    for name, built in zip(("players", "teamframe", "plays"), P.feature_tables(tracking(spark, sf))):
        _, keys, values = _TABLE_VALUES[name]
        cells = F.array(*[F.struct(F.lit(v).alias("column"), F.col(v).cast("double").alias("value")) for v in values])
        key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
        rows = built.select(F.lit(name).alias("name"), key.alias("key"), F.inline(cells))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "first_row_per_play",
    f"""SELECT {K4}, {same("x", "y")} FROM tracking QUALIFY row_number() OVER (
      PARTITION BY game_id, play_id ORDER BY frame_id, nfl_id) = 1""",
)
def _(spark, sf):
    return rollups.first_row_per_play(tracking(spark, sf)).select(*ROW_KEYS, "x", "y")


# Players numbered so that two rows of a frame share a key; their pairs add up under the key.
_SHARED_SQL = f"""WITH shared AS (SELECT * REPLACE (nfl_id % 11 AS nfl_id) FROM tracking),
  met AS (SELECT l.game_id, l.play_id, l.nfl_id, l.frame_id, l.player_side = r.player_side AS mate,
    sqrt((l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y)) AS d
    FROM shared l JOIN shared r ON l.game_id = r.game_id AND l.play_id = r.play_id
      AND l.frame_id = r.frame_id AND l.nfl_id <> r.nfl_id)
  SELECT route, {K4}, {q("min(d) FILTER (WHERE mate) AS distance_to_nearest_teammate",
    "min(d) FILTER (WHERE NOT mate) AS distance_to_nearest_opponent",
    "coalesce(sum(1e0 / (1e0 + d)) FILTER (WHERE NOT mate), 0e0) AS coverage_density")},
    CASE WHEN count(*) FILTER (WHERE NOT mate) > 0
      THEN CAST(count(*) FILTER (WHERE NOT mate AND d < 3) AS BIGINT) END AS opponents_within_3yds,
    CASE WHEN count(*) FILTER (WHERE mate) > 0
      THEN CAST(count(*) FILTER (WHERE mate AND d < 7) AS BIGINT) END AS teammates_within_7yds
  FROM met, (VALUES ('whole'), ('blocks')) AS r(route) GROUP BY route, {K4}"""


@query("coverage_repeated_keys", _SHARED_SQL)
def _(spark, sf):
    rows = tracking(spark, sf).withColumn("nfl_id", F.col("nfl_id") % 11)
    out = None
    for route, members in (("whole", spatial.MAX_MEMBERS), ("blocks", 4)):
        found = spatial.coverage_features(rows, max_members=members).select(
            F.lit(route).alias("route"), *ROW_KEYS,
            "distance_to_nearest_teammate", "distance_to_nearest_opponent", "coverage_density",
            "opponents_within_3yds", "teammates_within_7yds",
        )
        # Rows of one key carry equal values; the sums may differ in their last digit.
        each = found.groupBy("route", *ROW_KEYS).agg(
            *[F.max(c).alias(c) for c in found.columns if c not in ("route", *ROW_KEYS)]
        )
        out = each if out is None else out.unionByName(each)
    return out
