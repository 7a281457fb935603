"""Typed readers, table writers and path checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmotion.schemas import require_columns


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path, which may be a glob, names at least one entry."""
    filesystem, jvm_path = _filesystem(spark, path)
    found = filesystem.globStatus(jvm_path)
    return found is not None and len(found) > 0


def move_children(spark: SparkSession, folder: str, target: str, prefix: str) -> None:
    """Move the entries of a folder that start with prefix to target, without the prefix."""
    filesystem, jvm_path = _filesystem(spark, folder)
    into = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for entry in filesystem.listStatus(jvm_path):
        name = entry.getPath().getName()
        if name.startswith(prefix):
            filesystem.rename(entry.getPath(), into(f"{target}/{name.removeprefix(prefix)}"))


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a finished Spark write left its success marker."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def read_typed_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with header under a fixed schema.

    A value that does not fit fails the job, whichever columns are asked for, and so does a
    header that names other columns or names them in another order.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
    # The reader converts only the columns a query uses. This is true of every row, and uses all.
    return rows.where(F.xxhash64(*schema.names) >= F.lit(-(2**63)))


def read_untyped_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sampled: float = 1.0
) -> DataFrame:
    """CSV under a schema, or with types inferred from a share of its rows; label columns
    left over from a merge regain their names."""
    reader = spark.read.option("header", True)
    if schema is None:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampled)
    else:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if {"x_y", "y_y"} <= set(df.columns):
        df = df.withColumnsRenamed({"x_y": "x", "y_y": "y"})
    return df


def with_week_from_name(df: DataFrame) -> DataFrame:
    """Add week from '_wNN' in the file name, or in the folder's when the file is one of its parts."""
    location = F.col("_metadata.file_path")
    pattern = r"(?i)_w(\d{2})"
    name = F.element_at(F.split(location, "/"), -1)
    folder = F.element_at(F.split(location, "/"), -2)
    named = F.when(name.startswith("part-"), folder).otherwise(name)
    digits = F.nullif(F.regexp_extract(named, pattern, 1), F.lit(""))
    failure = F.raise_error(F.concat(F.lit("no week in file name: "), location)).cast("int")
    return df.withColumn("week", F.coalesce(digits.cast("int"), failure))


def file_inventory(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, n_rows, has_rows) for every CSV file under path; a folder of parts counts as one.

    Rows are counted by reading the files, which also checks all their values; the listing
    supplies the files without any.
    """

    def unit(column):
        part = F.regexp_extract(column, r"^(.*?)(/part-[^/]*)?$", 1)
        return F.regexp_replace(part, "^file:/+", "/").alias("file")

    listed = spark.read.format("binaryFile").load(path).select(unit(F.col("path"))).distinct()
    rows = read_typed_csv(spark, path, schema).select(unit(F.col("_metadata.file_path")))
    counted = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    n_rows = F.coalesce("n", F.lit(0))
    return listed.join(counted, "file", "left").select(
        "file", n_rows.alias("n_rows"), (n_rows > 0).alias("has_rows")
    )


def write_weekly(df: DataFrame, path: str, only_given_weeks: bool = False) -> None:
    """One Parquet dataset with a folder per week.

    Replaces the dataset and marks it complete, or with only_given_weeks replaces just the
    weeks in df (such a write leaves no success marker).
    """
    scope = "dynamic" if only_given_weeks else "static"
    (
        df.hint("rebalance", "week")  # even files, however large a week is
        .write.partitionBy("week")
        .mode("overwrite")
        .option("partitionOverwriteMode", scope)
        .parquet(path)
    )


def read_table(
    spark: SparkSession, path: str, columns: list[str] | None = None, required: list[str] = ()
) -> DataFrame:
    """Parquet scan; missing required columns are named, unselected ones are not read."""
    df = require_columns(spark.read.parquet(path), list(required), path)
    return df.select(*columns) if columns else df


def list_weeks(spark: SparkSession, path: str) -> DataFrame:
    """Weeks a dataset holds, taken from the names of its partition folders."""
    filesystem, jvm_path = _filesystem(spark, path)
    names = [entry.getPath().getName() for entry in filesystem.listStatus(jvm_path)]
    weeks = [(int(n.removeprefix("week=")),) for n in names if n.startswith("week=")]
    return spark.createDataFrame(weeks, "week int")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_metric(df: DataFrame, path: str) -> None:
    """Append metric rows to a small Parquet table."""
    df.write.mode("append").parquet(path)


def wide_vector(df: DataFrame, keys: list[str], vector: str, dim: int) -> DataFrame:
    """Vector positions as columns emb_000, emb_001, ..."""
    return df.select(
        *keys, *[F.get(F.col(vector), F.lit(i)).alias(f"emb_{i:03d}") for i in range(dim)]
    )


def union_all(tables: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by name; with a schema, columns are cast to it first."""
    if schema is not None:
        tables = [
            t.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]) for t in tables
        ]
    return reduce(lambda a, b: a.unionByName(b), tables)


def union_strict(tables: list[DataFrame]) -> DataFrame:
    """Union by name of tables whose column names and types agree exactly."""
    first = dict(tables[0].dtypes)
    for table in tables[1:]:
        if dict(table.dtypes) != first:
            raise ValueError(f"tables differ: {first} and {dict(table.dtypes)}")
    return reduce(lambda a, b: a.unionByName(b), tables)
