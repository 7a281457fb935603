"""Data-quality checks; each returns a table, and assert_* raises on findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmotion.schemas import PLAY_KEYS


def week_mismatch(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Weeks present on one side only: (week, missing_in)."""
    left, right = inputs.select("week").distinct(), outputs.select("week").distinct()
    return (
        right.subtract(left)
        .withColumn("missing_in", F.lit("input"))
        .unionByName(left.subtract(right).withColumn("missing_in", F.lit("output")))
    )


def assert_same_weeks(inputs: DataFrame, outputs: DataFrame) -> None:
    rows = week_mismatch(inputs, outputs).orderBy("week").collect()  # weeks are two digits
    if rows:
        detail = {
            side: [r.week for r in rows if r.missing_in == side] for side in ("input", "output")
        }
        raise ValueError(f"week mismatch, missing per side: {detail}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of duplicated keys and of rows that carry them."""
    return duplicate_keys(df, keys).agg(
        F.count(F.lit(1)).alias("duplicated_keys"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("duplicate_rows"),
    )


def assert_unique(df: DataFrame, keys: list[str], name: str, examples: int = 10) -> None:
    found = duplicate_keys(df, keys)
    shown = found.orderBy(*keys).limit(examples).collect()
    if shown:
        total = found.agg(F.sum("n_rows")).first()[0]
        raise ValueError(
            f"{name}: key {keys} not unique, {total} duplicate rows, e.g. "
            f"{[tuple(r)[:-1] for r in shown]}"
        )


def numeric_profile(df: DataFrame, columns: list[str], sigmas: float = 5.0) -> DataFrame:
    """One row per column: moments, range, nulls, infinities, and whether a value lies beyond
    `sigmas` deviations. One pass over the table, however many columns."""
    columns = [c for c in columns if c in df.columns]
    inf = float("inf")
    stats = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        number = F.when(~F.isnan(value), value)
        stats += [
            F.avg(value).alias(f"mean_{i}"),
            F.stddev_samp(value).alias(f"std_{i}"),
            F.min(number).alias(f"min_{i}"),
            F.max(number).alias(f"max_{i}"),
            F.count(F.when(value.isNull(), 1)).alias(f"nulls_{i}"),
            F.coalesce(F.max(F.abs(number) == inf), F.lit(False)).alias(f"inf_{i}"),
        ]
    wide = df.agg(*stats)
    fields = ["mean", "std", "min", "max", "nulls", "inf"]
    per_column = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{f}_{i}").alias(f) for f in fields])
            for i, c in enumerate(columns)
        ]
    )
    flat = wide.select(F.inline(per_column))
    reach = sigmas * F.col("std")
    outlying = (F.col("std") > 0) & (
        (F.col("min") < F.col("mean") - reach) | (F.col("max") > F.col("mean") + reach)
    )
    return flat.select(
        "column",
        "mean",
        "std",
        "min",
        "max",
        F.col("nulls").alias("n_nulls"),
        F.col("inf").alias("has_inf"),
        F.coalesce(outlying, F.lit(False)).alias("beyond_sigmas"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Rows (column, n_nulls) for every column."""
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_nulls")) for c in df.columns]
    )
    return wide.select(F.inline(pairs))


def table_summary(df: DataFrame) -> DataFrame:
    """Rows (position, column, type, n_rows): shape and columns in one table."""
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(t).alias("type")
            )
            for i, (n, t) in enumerate(df.dtypes)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(entries), "n_rows")


def sample_rows(df: DataFrame, keys: list[str], n: int = 3) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def prediction_count_mismatch(
    predictions: DataFrame, truth: DataFrame, keys: list[str] = PLAY_KEYS
) -> DataFrame:
    """Plays whose number of predictions differs from the number of labels."""
    n_pred = predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pred"))
    n_true = truth.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_true"))
    zero = F.lit(0).cast("bigint")
    both = n_pred.join(n_true, keys, "full").select(
        *keys,
        F.coalesce("n_pred", zero).alias("n_pred"),
        F.coalesce("n_true", zero).alias("n_true"),
    )
    return both.where(F.col("n_pred") != F.col("n_true"))


def assert_prediction_counts(
    predictions: DataFrame, truth: DataFrame, keys: list[str] = PLAY_KEYS, examples: int = 10
) -> None:
    found = prediction_count_mismatch(predictions, truth, keys)
    shown = found.orderBy(*keys).limit(examples).collect()
    if shown:
        raise ValueError(
            f"{found.count()} plays have other numbers of predictions than of labels, e.g. "
            f"{[tuple(r) for r in shown]}"
        )


def assert_profile(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Numeric profile of a table; infinite values are an error."""
    profile = numeric_profile(df, columns)
    infinite = [r["column"] for r in profile.where("has_inf").collect()]  # a row a column
    if infinite:
        raise ValueError(f"{name}: infinite values in {infinite}")
    return profile


def assert_not_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows left in {what}")
    return df
