"""CSV to Parquet ingest, and the resumable feature build on top of it."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmotion.operators.quality import (
    assert_not_empty,
    assert_profile,
    assert_same_weeks,
    assert_unique,
)
from gridmotion.plans.tables import players_table, plays_table, teamframe_table
from gridmotion.schemas import (
    FRAME_KEYS,
    LABEL_SCHEMA,
    PLAY_KEYS,
    SIDE_FRAME_KEYS,
    TEST_WEEK,
    TRACKING_SCHEMA,
)
from gridmotion.sources import files

log = logging.getLogger(__name__)

# File names of the raw data.
INPUT_PATTERN = "input_2023_w*.csv"
OUTPUT_PATTERN = "output_2023_w*.csv"
TEST_INPUT = "test_input.csv"
TEST_OUTPUT = "test.csv"


def read_weekly_csv(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """All files of a glob in one scan, with week; no file, or an empty one, is an error."""
    if not files.path_exists(spark, pattern):
        raise FileNotFoundError(f"no files match {pattern}")
    empty = files.file_inventory(spark, pattern, schema).where("NOT has_rows").select("file")
    found = [r.file for r in empty.limit(10).collect()]
    if found:
        raise ValueError(f"files without rows, e.g.: {found}")
    return files.with_week_from_name(files.read_typed_csv(spark, pattern, schema))


def read_test_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Test file as week -1, or None with a note when it is absent."""
    if not files.path_exists(spark, path):
        log.info("%s not found, skipped", path)
        return None
    return files.read_typed_csv(spark, path, schema).withColumn("week", F.lit(TEST_WEEK))


def ingest(spark: SparkSession, raw: str, out: str, test_labels: bool = True) -> list[str]:
    """Convert raw CSV to Parquet datasets under out; returns the paths written."""
    targets = {
        f"{out}/train_input": read_weekly_csv(spark, f"{raw}/{INPUT_PATTERN}", TRACKING_SCHEMA),
        f"{out}/train_output": read_weekly_csv(spark, f"{raw}/{OUTPUT_PATTERN}", LABEL_SCHEMA),
        f"{out}/test_input": read_test_csv(spark, f"{raw}/{TEST_INPUT}", TRACKING_SCHEMA),
    }
    if test_labels:
        targets[f"{out}/test_output"] = read_test_csv(spark, f"{raw}/{TEST_OUTPUT}", LABEL_SCHEMA)
    written = []
    for path, table in targets.items():
        if table is not None:
            files.write_weekly(table, path)
            written.append(path)
    assert_same_weeks(
        files.list_weeks(spark, f"{out}/train_input"),
        files.list_weeks(spark, f"{out}/train_output"),
    )
    return written


def ingest_if_needed(
    spark: SparkSession, raw: str, out: str, test_labels: bool = True
) -> list[str]:
    """Run the ingest unless every target is complete."""
    needed = ["train_input", "train_output", "test_input"] + ["test_output"] * test_labels
    if all(files.is_complete(spark, f"{out}/{name}") for name in needed):
        return []
    return ingest(spark, raw, out, test_labels)


def build_features(spark: SparkSession, tracking: DataFrame, out: str) -> dict[str, str]:
    """Write players, teamframe and plays by week, skipping weeks that are finished.

    A week enters the list of finished weeks after all three tables hold it; a week
    interrupted before that is rebuilt.
    """
    paths = {name: f"{out}/{name}" for name in ("players", "teamframe", "plays")}
    finished = f"{out}/finished_weeks"
    pending = tracking
    if files.path_exists(spark, finished):
        pending = tracking.join(spark.read.parquet(finished), "week", "left_anti")
    weeks = pending.select("week").distinct()
    if weeks.isEmpty():
        return paths
    play_week = pending.select(*PLAY_KEYS, "week").distinct()

    def write(table: DataFrame, name: str) -> None:
        files.write_weekly(table, paths[name], only_given_weeks=True)

    write(players_table(pending, keep=("week",)), "players")
    write(teamframe_table(pending, keep=("week",)), "teamframe")
    players, teamframe = (
        spark.read.parquet(paths[name]).join(weeks, "week", "left_semi").drop("week")
        for name in ("players", "teamframe")
    )
    write(plays_table(players, teamframe).join(play_week, PLAY_KEYS), "plays")
    done = spark.read.parquet(paths["plays"]).join(weeks, "week", "left_semi")
    done.select("week").distinct().write.mode("append").parquet(finished)
    return paths


def check_features(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """All tables exist, hold rows without infinite values, and have unique keys.

    Returns the numeric profile of each table.
    """
    profiles = {}
    keys = {
        "players": [*FRAME_KEYS, "nfl_id"],
        "teamframe": SIDE_FRAME_KEYS,
        "plays": PLAY_KEYS,
    }
    for name, path in paths.items():
        if not files.path_exists(spark, path):
            raise FileNotFoundError(f"missing table {name}: {path}")
        table = assert_not_empty(spark.read.parquet(path), name)
        assert_unique(table, keys[name], name)
        numbers = [
            f.name for f in table.schema.fields if isinstance(f.dataType, T.NumericType)
        ]
        profiles[name] = assert_profile(table, numbers, name)
    return profiles
