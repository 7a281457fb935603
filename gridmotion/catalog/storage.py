"""Queries over sources, sinks and data-quality checks.

They write to a fresh folder in the session's shared directory and read it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmotion.catalog import sqltext as X
from gridmotion.catalog.base import labels, q, query, table, tracking
from gridmotion.catalog.features import K4, same
from gridmotion.operators import quality, rollups
from gridmotion.operators.models import kinematic_projection
from gridmotion.operators.normalize import rightward
from gridmotion.plans import chunks
from gridmotion.plans import tables as P
from gridmotion.schemas import (
    LABEL_SCHEMA,
    PLAYER_COLUMNS,
    ROW_KEYS,
    TRACKING_SCHEMA,
)
from gridmotion.session import scratch_path
from gridmotion.sources import files, ingest

_DOUBLES = ["x", "y", "s", "a", "dir", "o", "ball_land_x", "ball_land_y"]
_OTHERS = [
    "CAST(player_birth_date AS VARCHAR) AS player_birth_date" if n == "player_birth_date" else n
    for n in TRACKING_SCHEMA.names
    if n not in _DOUBLES
]
_TRACKING_SQL = f"SELECT {', '.join(_OTHERS)}, {same(*_DOUBLES)} FROM tracking"
_LABEL_SQL = f"SELECT {K4}, {same('x', 'y')} FROM labels"


def _write_weekly_csv(rows, prefix: str, root: str) -> None:
    """One folder of parts per week, named like the weekly raw files."""
    week = F.lpad(F.col("week").cast("string"), 2, "0")
    name = F.concat(F.lit(f"{prefix}_2023_w"), week, F.lit(".csv"))
    parts = f"{root}/parts-{prefix}"
    rows.withColumn("file", name).drop("week").write.partitionBy("file").option("header", True).csv(parts)
    files.move_children(rows.sparkSession, parts, root, "file=")


def _raw(spark, sf, test: bool = False) -> str:
    """Raw CSV folders of tracking and label rows; returns globs' common root."""
    root = scratch_path(spark, "raw")
    columns = [f.name for f in TRACKING_SCHEMA]
    inputs = tracking(spark, sf).select(*columns, "week")
    outputs = labels(spark, sf).select(*[f.name for f in LABEL_SCHEMA], "week")
    _write_weekly_csv(inputs, "input", root)
    _write_weekly_csv(outputs, "output", root)
    if test:
        inputs.drop("week").write.option("header", True).csv(
            f"{root}/{ingest.TEST_INPUT}"
        )
    return root


def _inputs(root: str) -> str:
    return f"{root}/{ingest.INPUT_PATTERN}"


def _outputs(root: str) -> str:
    return f"{root}/{ingest.OUTPUT_PATTERN}"


@query("typed_csv_scan", _TRACKING_SQL)
def _(spark, sf):
    return files.read_typed_csv(spark, _inputs(_raw(spark, sf)), TRACKING_SCHEMA)


@query("typed_csv_label_scan", _LABEL_SQL)
def _(spark, sf):
    return files.read_typed_csv(spark, _outputs(_raw(spark, sf)), LABEL_SCHEMA)


@query(
    "weekly_csv_union",
    _TRACKING_SQL.replace("SELECT ", "SELECT week, ", 1),
)
def _(spark, sf):
    return ingest.read_weekly_csv(spark, _inputs(_raw(spark, sf)), TRACKING_SCHEMA)


@query(
    "test_csv_scan",
    _TRACKING_SQL.replace("SELECT ", "SELECT CAST(-1 AS BIGINT) AS week, ", 1),
)
def _(spark, sf):
    root = _raw(spark, sf, test=True)
    missing = ingest.read_test_csv(spark, f"{root}/{ingest.TEST_OUTPUT}", LABEL_SCHEMA)
    assert missing is None
    return ingest.read_test_csv(spark, f"{root}/{ingest.TEST_INPUT}", TRACKING_SCHEMA)


def _stored(spark, sf, name="tracking"):
    path = scratch_path(spark, name)
    files.write_weekly(tracking(spark, sf), path)
    return path


@query(
    "weekly_parquet",
    _TRACKING_SQL.replace("SELECT ", "SELECT week, ", 1),
)
def _(spark, sf):
    return files.read_table(spark, _stored(spark, sf), required=["week", *ROW_KEYS])


@query("combined_parquet", _TRACKING_SQL.replace("SELECT ", "SELECT week, ", 1))
def _(spark, sf):
    return files.read_table(spark, _stored(spark, sf), [*[f.name for f in TRACKING_SCHEMA], "week"])


@query("pruned_scan", "SELECT DISTINCT nfl_id FROM tracking")
def _(spark, sf):
    return files.read_table(spark, _stored(spark, sf), ["nfl_id"]).distinct()


@query("list_weeks", "SELECT DISTINCT week FROM tracking")
def _(spark, sf):
    return files.list_weeks(spark, _stored(spark, sf))


@query(
    "untyped_csv_renamed",
    f"SELECT {K4}, {q('t.s AS s', 'l.x AS x', 'l.y AS y')} FROM tracking t JOIN labels l USING ({K4})",
)
def _(spark, sf):
    path = scratch_path(spark, "combined.csv")
    right = labels(spark, sf).select(*ROW_KEYS, F.col("x").alias("x_y"), F.col("y").alias("y_y"))
    files.write_csv(tracking(spark, sf).select(*ROW_KEYS, "s").join(right, ROW_KEYS), path)
    return files.read_untyped_csv(spark, path).select(*ROW_KEYS, "s", "x", "y")


@query(
    "ingest_csv_to_parquet",
    """SELECT 'train_input' AS dataset, week, CAST(count(*) AS BIGINT) AS n_rows FROM tracking GROUP BY week
    UNION ALL SELECT 'train_output', week, CAST(count(*) AS BIGINT) FROM labels GROUP BY week
    UNION ALL SELECT 'test_input', -1, CAST(count(*) AS BIGINT) FROM tracking""",
)
def _(spark, sf):
    root, out = _raw(spark, sf, test=True), scratch_path(spark, "parquet")
    counted = [
        spark.read.parquet(path)
        .groupBy("week")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(path.rsplit("/", 1)[1]).alias("dataset"), "week", "n_rows")
        for path in ingest.ingest(spark, root, out, test_labels=False)
    ]
    return files.union_strict(counted)


@query(
    "ingested_rows",
    _TRACKING_SQL.replace("SELECT ", "SELECT week, CAST(0 AS BIGINT) AS n_again, ", 1),
)
def _(spark, sf):
    """All rows after an ingest that ran because it was needed; a second one writes nothing."""
    root, out = _raw(spark, sf, test=True), scratch_path(spark, "parquet")
    ingest.ingest_if_needed(spark, root, out, test_labels=False)
    again = ingest.ingest_if_needed(spark, root, out, test_labels=False)
    return spark.read.parquet(f"{out}/train_input").withColumn("n_again", F.lit(len(again)))


_PLAY_NAMES = [f"{v}_{s}" for v in X.MEAN_NAMES + X.SHAPE_NAMES for s in ("Offense", "Defense")]


@query(
    "resumable_feature_build",
    f"SELECT game_id, play_id, week, {same(*_PLAY_NAMES)} FROM plays JOIN "
    "(SELECT DISTINCT game_id, play_id, week FROM tracking) USING (game_id, play_id)",
    X.PLAYS,
)
def _(spark, sf):
    out, rows = scratch_path(spark, "features"), tracking(spark, sf)
    ingest.build_features(spark, rows.where("week % 2 = 1"), out)
    paths = ingest.build_features(spark, rows, out)  # picks up the other weeks
    ingest.check_features(spark, paths)
    return spark.read.parquet(paths["plays"])


_LAST_PROJECTED = f"SELECT {K4}, {same('pred_x', 'pred_y')} FROM projected"


@query("csv_prediction_sink", _LAST_PROJECTED, ("last_rows", "projected"))
def _(spark, sf):
    path = scratch_path(spark, "predictions.csv")
    predictions = kinematic_projection(tracking(spark, sf))
    files.write_csv(predictions, path)
    return files.read_typed_csv(spark, path, predictions.schema)


@query(
    "metric_sink",
    f"""SELECT metric, {q("value AS value")} FROM (SELECT 'mean_speed' AS metric, avg(s) AS value FROM tracking
    UNION ALL SELECT 'mean_accel', avg(a) FROM tracking)""",
)
def _(spark, sf):
    path, rows = scratch_path(spark, "metrics"), tracking(spark, sf)
    for name, column in (("mean_speed", "s"), ("mean_accel", "a")):
        files.append_metric(
            rows.agg(F.avg(column).alias("value")).select(F.lit(name).alias("metric"), "value"), path
        )
    return spark.read.parquet(path)


_EMB = ", ".join(
    f"round(avg(CAST(embedding[{i + 1}] AS DOUBLE)), 6) + 0e0 AS emb_{i:03d}" for i in range(64)
)


@query(
    "wide_embedding_export",
    f"SELECT CAST(label AS BIGINT) AS label, {_EMB} FROM embeddings GROUP BY label",
)
def _(spark, sf):
    pooled = rollups.pool_vectors(table(spark, sf, "embeddings"), ["label"], "embedding", 64)
    path = scratch_path(spark, "embeddings")
    files.wide_vector(pooled, ["label"], "embedding", 64).write.parquet(path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ quality


@query(
    "file_inventory",
    """SELECT concat('input_2023_w', lpad(CAST(week AS VARCHAR), 2, '0'), '.csv') AS file,
      CAST(count(*) AS BIGINT) AS n_rows, true AS has_rows FROM tracking GROUP BY week
    UNION ALL SELECT 'input_2023_w98.csv', 0, false UNION ALL SELECT 'input_2023_w99.csv', 0, false""",
)
def _(spark, sf):
    root = _raw(spark, sf)
    empty = spark.createDataFrame([], TRACKING_SCHEMA).coalesce(1)
    empty.write.option("header", True).csv(f"{root}/input_2023_w99.csv")
    # A header followed by blank lines holds no rows, however long the file is.
    blank = spark.createDataFrame([(",".join(TRACKING_SCHEMA.names) + "\n" * 60,)], "line string")
    blank.coalesce(1).write.text(f"{root}/input_2023_w98.csv")
    found = files.file_inventory(spark, _inputs(root), TRACKING_SCHEMA)
    name = F.regexp_extract("file", "(input_2023_w.*)$", 1).alias("file")
    return found.select(name, "n_rows", "has_rows")


# All weeks of the input against all weeks of the labels, these being numbered one on.
_SOME = "SELECT week FROM tracking"
_OTHER = "SELECT week + 1 AS week FROM labels"


@query(
    "week_mismatch",
    f"""SELECT week, 'output' AS missing_in FROM ({_SOME} EXCEPT {_OTHER})
    UNION ALL SELECT week, 'input' FROM ({_OTHER} EXCEPT {_SOME})""",
)
def _(spark, sf):
    moved = labels(spark, sf).withColumn("week", F.col("week") + 1)
    return quality.week_mismatch(tracking(spark, sf), moved)


@query(
    "key_uniqueness",
    f"""SELECT 'tracking' AS name, CAST(count(*) AS BIGINT) AS duplicated_keys,
      CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
      FROM (SELECT count(*) AS n FROM tracking GROUP BY {K4} HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem', CAST(count(*) AS BIGINT), CAST(coalesce(sum(n), 0) AS BIGINT)
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)""",
)
def _(spark, sf):
    first = quality.key_uniqueness(tracking(spark, sf), ROW_KEYS)
    second = quality.key_uniqueness(table(spark, sf, "lineitem"), ["l_orderkey"])
    names = ((first, "tracking"), (second, "lineitem"))
    parts = [t.select(F.lit(n).alias("name"), "duplicated_keys", "duplicate_rows") for t, n in names]
    return parts[0].unionByName(parts[1])


@query(
    "duplicate_keys",
    "SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def _(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey"])


_PROFILED = ["x_norm", "y_norm", "dir_norm", "o_norm", "s", "a"]
_PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {q(f"avg({c}) AS mean", f"stddev_samp({c}) AS std",
      f"min({c}) AS min", f"max({c}) AS max")}, CAST(count(*) - count({c}) AS BIGINT) AS n_nulls,
      coalesce(bool_or(isinf({c})), false) AS has_inf,
      coalesce(stddev_samp({c}) > 0 AND (min({c}) < avg({c}) - 5 * stddev_samp({c})
        OR max({c}) > avg({c}) + 5 * stddev_samp({c})), false) AS beyond_sigmas FROM norm"""
    for c in _PROFILED
)


@query("numeric_profile", _PROFILE_SQL, ("norm",))
def _(spark, sf):
    return quality.numeric_profile(rightward(tracking(spark, sf)), [*_PROFILED, "absent"])


@query(
    "numeric_profile_lineitem",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {q(f"avg({c}) AS mean", f"stddev_samp({c}) AS std",
          f"CAST(min({c}) AS DOUBLE) AS min", f"CAST(max({c}) AS DOUBLE) AS max")},
          CAST(count(*) - count({c}) AS BIGINT) AS n_nulls, false AS has_inf,
          stddev_samp({c}) > 0 AND (min({c}) < avg({c}) - 5 * stddev_samp({c})
            OR max({c}) > avg({c}) + 5 * stddev_samp({c})) AS beyond_sigmas FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def _(spark, sf):
    return quality.numeric_profile(
        table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]
    )


@query(
    "null_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS n_nulls FROM timed"""
        for c in ("s", "a", "speed_rolling_mean_3", "speed_rolling_std_5", "cumulative_distance")
    ),
    X.TIMED,
)
def _(spark, sf):
    players = P.players_table(tracking(spark, sf)).select(
        "s", "a", "speed_rolling_mean_3", "speed_rolling_std_5", "cumulative_distance"
    )
    return quality.null_counts(players)


_SUMMARY = " UNION ALL ".join(
    f"""SELECT CAST({i} AS BIGINT) AS position, '{c}' AS "column", CAST(count(*) AS BIGINT) AS n_rows FROM tracking"""
    for i, c in enumerate(PLAYER_COLUMNS)
)


@query("table_summary", _SUMMARY)
def _(spark, sf):
    players = P.players_table(tracking(spark, sf))
    return quality.table_summary(players).select("position", "column", "n_rows")


@query(
    "sample_rows",
    f"SELECT {K4}, {same('x', 'y')} FROM tracking ORDER BY {K4} LIMIT 3",
)
def _(spark, sf):
    return quality.sample_rows(tracking(spark, sf), ROW_KEYS).select(*ROW_KEYS, "x", "y")


@query(
    "prediction_count_mismatch",
    """SELECT game_id, play_id, CAST(coalesce(n_pred, 0) AS BIGINT) AS n_pred,
      CAST(coalesce(n_true, 0) AS BIGINT) AS n_true
    FROM (SELECT game_id, play_id, count(*) AS n_pred FROM projected GROUP BY 1, 2)
    FULL JOIN (SELECT game_id, play_id, count(*) AS n_true FROM labels GROUP BY 1, 2) USING (game_id, play_id) WHERE coalesce(n_pred, 0) <> coalesce(n_true, 0)""",
    ("last_rows", "projected"),
)
def _(spark, sf):
    projected = kinematic_projection(tracking(spark, sf))
    return quality.prediction_count_mismatch(projected, labels(spark, sf))


@query(
    "prediction_count_mismatch_found",
    """SELECT game_id, play_id, CAST(coalesce(n_pred, 0) AS BIGINT) AS n_pred,
      CAST(coalesce(n_true, 0) AS BIGINT) AS n_true
    FROM (SELECT game_id, play_id, count(*) AS n_pred FROM projected WHERE frame_id <= 9 GROUP BY 1, 2)
    FULL JOIN (SELECT game_id, play_id, count(*) AS n_true FROM labels GROUP BY 1, 2) USING (game_id, play_id) WHERE coalesce(n_pred, 0) <> coalesce(n_true, 0)""",
    ("last_rows", "projected"),
)
def _(spark, sf):
    """Predictions that end at frame 9 leave out labels of longer flights."""
    projected = kinematic_projection(tracking(spark, sf)).where("frame_id <= 9")
    return quality.prediction_count_mismatch(projected, labels(spark, sf))


@query(
    "chunked_feature_build",
    f"""SELECT game_id, play_id, {same(*_PLAY_NAMES)} FROM plays""",
    X.PLAYS,
)
def _(spark, sf):
    """Chunks of a week and game: an interrupted run, then late rows of chunks that were finished."""
    out, rows = scratch_path(spark, "chunks"), tracking(spark, sf)
    keys = ["week", "game_id"]
    chunks.build_in_chunks(spark, rows.where("game_id % 2 = 0"), out, keys, stop_before="plays")
    chunks.build_in_chunks(spark, rows.where("frame_id <= 9"), out, keys)
    paths = chunks.build_in_chunks(spark, rows, out, keys)
    return spark.read.parquet(paths["plays"]).drop("week")
