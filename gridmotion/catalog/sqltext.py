"""SQL of the larger tables, shared by several queries."""

from gridmotion.catalog.base import CTES

_TIMELINE = "PARTITION BY game_id, play_id, nfl_id ORDER BY frame_id"


def rolling(column: str, label: str, size: int) -> str:
    frame = f"OVER ({_TIMELINE} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    full = f"count({column}) {frame} = {size}"
    return (
        f"CASE WHEN {full} THEN avg({column}) {frame} END AS {label}_rolling_mean_{size}, "
        f"CASE WHEN {full} THEN stddev_samp({column}) {frame} END AS {label}_rolling_std_{size}"
    )


def floored_mod(expr: str, by: str = "360e0") -> str:
    return f"(({expr}) - {by} * floor(({expr}) / {by}))"


ROLLING = ", ".join(
    rolling(c, label, n) for n in (3, 5) for c, label in (("s", "speed"), ("a", "accel"))
)
TURN = floored_mod(f"dir_norm - lag(dir_norm) OVER ({_TIMELINE}) + 180e0") + " - 180e0"
STEP_X = f"x_norm - lag(x_norm) OVER ({_TIMELINE})"
STEP_Y = f"y_norm - lag(y_norm) OVER ({_TIMELINE})"
HEIGHT = """CASE WHEN player_height IS NULL THEN NULL
  WHEN regexp_full_match(player_height, '[0-9]+-[0-9]+')
  THEN CAST(split_part(player_height, '-', 1) AS DOUBLE) * 12
    + CAST(split_part(player_height, '-', 2) AS DOUBLE)
  ELSE CAST('NaN' AS DOUBLE) END"""
AGE = "date_diff('day', player_birth_date, DATE '2023-09-01') / 365.25e0"
BMI = """CASE WHEN player_weight IS NULL OR height_in IS NULL OR player_weight = 0 OR height_in <= 0
  THEN CAST('NaN' AS DOUBLE) ELSE player_weight * 703e0 / (height_in * height_in) END"""

CTES["stepped"] = f"""SELECT *, {ROLLING}, {TURN} AS angular_velocity,
  {STEP_X} AS delta_x, {STEP_Y} AS delta_y FROM norm"""
CTES["timed"] = f"""SELECT *, CASE WHEN delta_x IS NOT NULL AND delta_y IS NOT NULL
  THEN sum(sqrt(delta_x * delta_x + delta_y * delta_y)) OVER ({_TIMELINE}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cumulative_distance FROM stepped"""
CTES["scalars"] = f"""SELECT *, {BMI} AS player_bmi, s * dir_cos AS vx, s * dir_sin AS vy,
  a * dir_cos AS ax, a * dir_sin AS ay FROM (
    SELECT *, {HEIGHT} AS height_in, {AGE} AS player_age,
      sin(radians(dir_norm)) AS dir_sin, cos(radians(dir_norm)) AS dir_cos,
      sin(radians(o_norm)) AS o_sin, cos(radians(o_norm)) AS o_cos FROM timed)"""

_SIDE_FRAME = "game_id, play_id, frame_id, player_side"
CTES["shape"] = f"""SELECT {_SIDE_FRAME}, max(y_norm) - min(y_norm) AS formation_width,
  max(x_norm) - min(x_norm) AS formation_depth, avg(x_norm) AS formation_x_mean,
  avg(y_norm) AS formation_y_mean FROM norm GROUP BY {_SIDE_FRAME}"""
CTES["shaped"] = f"""SELECT n.*, formation_width, formation_depth, formation_x_mean,
  formation_y_mean, x_norm - formation_x_mean AS relative_formation_depth,
  y_norm - formation_y_mean AS relative_formation_width,
  sqrt((x_norm - formation_x_mean) * (x_norm - formation_x_mean)
    + (y_norm - formation_y_mean) * (y_norm - formation_y_mean)) AS distance_to_formation_center
  FROM norm n LEFT JOIN shape USING ({_SIDE_FRAME})"""
CTES["pairs"] = """SELECT l.game_id, l.play_id, l.frame_id, l.nfl_id, r.nfl_id AS other_id,
  l.player_side = r.player_side AS same_side,
  sqrt((l.x_norm - r.x_norm) * (l.x_norm - r.x_norm)
    + (l.y_norm - r.y_norm) * (l.y_norm - r.y_norm)) AS dist
  FROM norm l JOIN norm r ON l.game_id = r.game_id AND l.play_id = r.play_id
    AND l.frame_id = r.frame_id AND l.nfl_id <> r.nfl_id"""


def _within(radius: int, label: str, test: str) -> str:
    seen = f"count(*) FILTER (WHERE {test})"
    near = f"count(*) FILTER (WHERE {test} AND dist < {radius}e0)"
    return f"CASE WHEN {seen} > 0 THEN CAST({near} AS BIGINT) END AS {label}_within_{radius}yds"


WITHIN = ", ".join(
    _within(r, label, test)
    for label, test in (("opponents", "NOT same_side"), ("teammates", "same_side"))
    for r in (3, 5, 7)
)
CTES["near"] = f"""SELECT game_id, play_id, frame_id, nfl_id,
  min(dist) FILTER (WHERE same_side) AS distance_to_nearest_teammate,
  min(dist) FILTER (WHERE NOT same_side) AS distance_to_nearest_opponent,
  coalesce(sum(1e0 / (1e0 + dist)) FILTER (WHERE NOT same_side), 0e0) AS coverage_density,
  {WITHIN} FROM pairs GROUP BY game_id, play_id, frame_id, nfl_id"""
CTES["covered"] = """SELECT * FROM shaped
  LEFT JOIN near USING (game_id, play_id, frame_id, nfl_id)"""

_SUMS = ", ".join(
    f"CAST(coalesce(sum({label}_within_{r}yds), 0) AS BIGINT) AS {short}_within_{r}yds_sum"
    for label, short in (("opponents", "opp"), ("teammates", "tm"))
    for r in (3, 5, 7)
)
CTES["teamframe"] = f"""SELECT {_SIDE_FRAME}, max(formation_width) AS formation_width,
  max(formation_depth) AS formation_depth, max(formation_x_mean) AS formation_x_mean,
  max(formation_y_mean) AS formation_y_mean,
  avg(distance_to_formation_center) AS team_spread_mean,
  stddev_samp(relative_formation_depth) AS depth_std,
  stddev_samp(relative_formation_width) AS width_std,
  avg(distance_to_nearest_teammate) AS nn_teammate_mean,
  avg(distance_to_nearest_opponent) AS nn_opponent_mean,
  avg(coverage_density) AS coverage_density_mean, {_SUMS}
  FROM covered GROUP BY {_SIDE_FRAME}"""

SHAPE = ("norm", "shape", "shaped")
COVERAGE = (*SHAPE, "pairs", "near", "covered")
TEAMFRAME = (*COVERAGE, "teamframe")
TIMED = ("norm", "stepped", "timed")
PLAYERS = (*TIMED, "scalars")

_LAST = """SELECT t.* FROM {t} t JOIN (SELECT game_id, play_id, player_side,
  max(frame_id) AS frame_id FROM {t} GROUP BY 1, 2, 3)
  USING (game_id, play_id, player_side, frame_id)"""
CTES["last_means"] = f"""SELECT game_id, play_id, player_side, avg(s) AS mean_speed_last,
  avg(a) AS mean_accel_last, avg(x_norm) AS mean_x_last, avg(y_norm) AS mean_y_last
  FROM ({_LAST.format(t='norm')}) GROUP BY 1, 2, 3"""
CTES["last_shape"] = f"""SELECT game_id, play_id, player_side, formation_width, formation_depth
  FROM ({_LAST.format(t='teamframe')})"""


def pivoted(values: list[str], source: str) -> str:
    picks = ", ".join(
        f"max({v}) FILTER (WHERE player_side = '{s}') AS {v}_{s}"
        for v in values
        for s in ("Offense", "Defense")
    )
    return f"SELECT game_id, play_id, {picks} FROM {source} GROUP BY game_id, play_id"


MEAN_NAMES = ["mean_speed_last", "mean_accel_last", "mean_x_last", "mean_y_last"]
SHAPE_NAMES = ["formation_width", "formation_depth"]
CTES["plays"] = f"""SELECT * FROM ({pivoted(MEAN_NAMES, 'last_means')})
  FULL JOIN ({pivoted(SHAPE_NAMES, 'last_shape')}) USING (game_id, play_id)"""
PLAYS = (*TEAMFRAME, "last_means", "last_shape", "plays")

# The first frame of each side, and five features of it.
CTES["first_rows"] = """SELECT n.* FROM norm n JOIN (SELECT game_id, play_id, player_side,
  min(frame_id) AS frame_id FROM norm GROUP BY 1, 2, 3)
  USING (game_id, play_id, player_side, frame_id)"""
CTES["centres"] = """SELECT game_id, play_id, player_side, max(x_norm) - min(x_norm) AS width_x,
  max(y_norm) - min(y_norm) AS width_y, avg(x_norm) AS center_x, avg(y_norm) AS center_y
  FROM first_rows GROUP BY 1, 2, 3"""
CTES["matrix"] = """SELECT game_id, play_id, player_side, max(width_x) AS width_x,
  max(width_y) AS width_y, max(center_x) AS center_x, max(center_y) AS center_y,
  avg(sqrt((x_norm - center_x) * (x_norm - center_x) + (y_norm - center_y) * (y_norm - center_y)))
    AS mean_dist_to_center
  FROM first_rows JOIN centres USING (game_id, play_id, player_side) GROUP BY 1, 2, 3"""
MATRIX = ("norm", "first_rows", "centres", "matrix")

# Last input row of each timeline, and the label rows beside it.
CTES["last_rows"] = """SELECT * FROM tracking QUALIFY row_number() OVER (
  PARTITION BY game_id, play_id, nfl_id ORDER BY frame_id DESC) = 1"""
CTES["projected"] = """SELECT game_id, play_id, nfl_id, k AS frame_id,
  x + s * sin(radians(dir)) * k * 0.1e0 AS pred_x, y + s * cos(radians(dir)) * k * 0.1e0 AS pred_y
  FROM last_rows, unnest(range(1, num_frames_output + 1)) AS r(k) WHERE player_to_predict"""
CTES["matched"] = """SELECT p.game_id, p.play_id, p.nfl_id, p.frame_id, p.pred_x AS x_pred,
  p.pred_y AS y_pred, l.x AS x_true, l.y AS y_true
  FROM projected p JOIN labels l USING (game_id, play_id, nfl_id, frame_id)"""
MATCHED = ("last_rows", "projected", "matched")
SQ = "((x_pred - x_true) * (x_pred - x_true) + (y_pred - y_true) * (y_pred - y_true))"
