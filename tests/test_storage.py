"""Ingest, sinks and the resumable feature build on files in a temporary folder."""

import pytest
from pyspark.sql import functions as F

from gridmotion.catalog.base import labels, tracking
from gridmotion.schemas import LABEL_SCHEMA, TRACKING_SCHEMA
from gridmotion.sources import files, ingest


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    """Plain raw CSV files, one per week, as the source delivers them."""
    root = tmp_path_factory.mktemp("raw")
    inputs = tracking(spark, sf_dir).select(*TRACKING_SCHEMA.names).toPandas()
    outputs = labels(spark, sf_dir).select(*LABEL_SCHEMA.names).toPandas()
    for week in (1, 2):
        inputs[inputs.play_id % 2 == week % 2].to_csv(root / f"input_2023_w{week:02d}.csv", index=False)
        outputs[outputs.play_id % 2 == week % 2].to_csv(root / f"output_2023_w{week:02d}.csv", index=False)
    inputs[inputs.play_id == 1].to_csv(root / "test_input.csv", index=False)
    return str(root)


def test_ingest_then_skip(spark, raw, sf_dir, tmp_path):
    out = str(tmp_path)
    written = ingest.ingest(spark, raw, out)
    assert [p.rsplit("/", 1)[1] for p in written] == ["train_input", "train_output", "test_input"]
    rows = files.read_table(spark, f"{out}/train_input", required=["week"])
    assert rows.count() == tracking(spark, sf_dir).count()
    assert {r.week for r in files.list_weeks(spark, f"{out}/train_input").collect()} == {1, 2}
    assert rows.where("week = 1 and play_id % 2 = 0").isEmpty()
    assert {f.name: f.dataType for f in rows.schema if f.name != "week"} == {
        f.name: f.dataType for f in TRACKING_SCHEMA
    }
    assert spark.read.parquet(f"{out}/test_input").select("week").distinct().first().week == -1
    assert ingest.ingest_if_needed(spark, raw, out, test_labels=False) == []
    assert ingest.ingest_if_needed(spark, raw, out, test_labels=True)  # no labels yet: runs again
    again = files.read_table(spark, f"{out}/train_input")
    assert again.count() == tracking(spark, sf_dir).count()


def test_bad_value_fails(spark, tmp_path):
    (tmp_path / "output_2023_w01.csv").write_text("game_id,play_id,nfl_id,frame_id,x,y\n1,1,1,1,oops,2\n")
    with pytest.raises(Exception, match="oops|MALFORMED|CANNOT_PARSE|FAILED"):
        ingest.read_weekly_csv(spark, f"{tmp_path}/{ingest.OUTPUT_PATTERN}", LABEL_SCHEMA)
    rows = files.read_typed_csv(spark, f"{tmp_path}/{ingest.OUTPUT_PATTERN}", LABEL_SCHEMA)
    with pytest.raises(Exception, match="oops|MALFORMED|CANNOT_PARSE|FAILED"):
        rows.select("game_id").collect()  # the bad value stands in another column
    (tmp_path / "turned_w01.csv").write_text("play_id,game_id,nfl_id,frame_id,x,y\n1,2,1,1,1.0,2.0\n")
    with pytest.raises(Exception, match="header|schema"):
        files.read_typed_csv(spark, f"{tmp_path}/turned_w01.csv", LABEL_SCHEMA).collect()


def test_missing_empty_and_unnamed_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.read_weekly_csv(spark, f"{tmp_path}/input_2023_w*.csv", TRACKING_SCHEMA)
    (tmp_path / "output_2023_w01.csv").write_text("game_id,play_id,nfl_id,frame_id,x,y\n1,1,1,1,1.0,2.0\n")
    (tmp_path / "output_2023_w02.csv").write_text("game_id,play_id,nfl_id,frame_id,x,y\n")
    with pytest.raises(ValueError, match="output_2023_w02"):
        ingest.read_weekly_csv(spark, f"{tmp_path}/{ingest.OUTPUT_PATTERN}", LABEL_SCHEMA)
    (tmp_path / "output_2023_w03.csv").write_text("game_id,play_id,nfl_id,frame_id,x,y\n" + "\n" * 99)
    inventory = files.file_inventory(spark, f"{tmp_path}/{ingest.OUTPUT_PATTERN}", LABEL_SCHEMA)
    found = {r.file[-7:-4]: (r.n_rows, r.has_rows) for r in inventory.collect()}
    assert found == {"w01": (1, True), "w02": (0, False), "w03": (0, False)}
    (tmp_path / "other.csv").write_text("game_id,play_id,nfl_id,frame_id,x,y\n1,1,1,1,1.0,2.0\n")
    (tmp_path / "data_w05").mkdir()
    (tmp_path / "data_w05" / "plain.csv").write_text("game_id,play_id,nfl_id,frame_id,x,y\n1,1,1,1,1.0,2.0\n")
    plain = files.read_typed_csv(spark, f"{tmp_path}/data_w05/plain.csv", LABEL_SCHEMA)
    with pytest.raises(Exception, match="no week in file name"):
        files.with_week_from_name(plain).collect()
    unnamed = files.with_week_from_name(files.read_typed_csv(spark, f"{tmp_path}/other.csv", LABEL_SCHEMA))
    with pytest.raises(Exception, match="no week in file name"):
        unnamed.collect()
    assert ingest.read_test_csv(spark, f"{tmp_path}/absent.csv", LABEL_SCHEMA) is None


def test_feature_build_resumes(spark, sf_dir, tmp_path):
    rows = tracking(spark, sf_dir).withColumn("week", (F.col("play_id") % 2 + 1).cast("int"))
    out = str(tmp_path)
    ingest.build_features(spark, rows.where("week = 1"), out)
    first = {r.play_id for r in spark.read.parquet(f"{out}/plays").collect()}
    # A second run must leave finished weeks alone: give it altered rows for week 1.
    altered = rows.withColumn("x", F.when(F.col("week") == 1, F.lit(0.0)).otherwise(F.col("x")))
    paths = ingest.build_features(spark, altered, out)
    ingest.check_features(spark, paths)
    plays = spark.read.parquet(paths["plays"])
    assert {r.play_id for r in plays.collect()} > first
    assert plays.where("week = 1 and mean_x_last_Offense in (0.0, 120.0)").isEmpty()
    assert spark.read.parquet(paths["players"]).count() == rows.count()
    assert ingest.build_features(spark, altered, out) == paths
    with pytest.raises(FileNotFoundError):
        ingest.check_features(spark, {"plays": f"{out}/nothing"})


def test_unions(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    b = spark.createDataFrame([(3, 4)], "v long, k long")
    assert {tuple(r) for r in files.union_all([a, b], a.schema).collect()} == {(1, 2), (4, 3)}
    with pytest.raises(ValueError):
        files.union_strict([a, b])


def test_untyped_csv_keeps_names_without_merge_suffix(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1.5,2\n")
    (tmp_path / "b.csv").write_text("x_y,y_y\n1.5,2\n")
    assert files.read_untyped_csv(spark, f"{tmp_path}/a.csv").columns == ["x", "y"]
    assert files.read_untyped_csv(spark, f"{tmp_path}/b.csv").columns == ["x", "y"]
