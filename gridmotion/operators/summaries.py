"""Quantiles of tables too large to order: summaries that are stored and merged.

A summary (a KLL sketch) keeps some thousand values of a group, whatever its size. Summaries of
parts of a group merge into one of the whole, so a new week is added without reading the others.
Each quantile comes with the interval of values that its rank error allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 4096  # values a summary keeps at a level, at most 65535


def rank_error(size: int = SIZE) -> float:
    """Error of a rank as a share of the rows, not exceeded in 99 of 100 summaries."""
    return 2.296 / size**0.9021


def quantile_summaries(df: DataFrame, keys: list[str], value: str, size: int = SIZE) -> DataFrame:
    """(keys, summary, n_values): combined on the map side, a summary a group. Missing values and NaN take no part."""
    number = F.col(value).cast("double")
    known = F.when(number.isNotNull() & ~F.isnan(number), number)
    kept = df.select(*keys, known.alias("__v")).where("__v IS NOT NULL")
    return kept.groupBy(*keys).agg(
        F.kll_sketch_agg_double("__v", F.lit(size)).alias("summary"), F.count(F.lit(1)).alias("n_values")
    )


def merge_summaries(summaries: DataFrame, keys: list[str], size: int = SIZE) -> DataFrame:
    """Summaries of coarser groups, from those of their parts."""
    return summaries.groupBy(*keys).agg(
        F.kll_merge_agg_double("summary", F.lit(size)).alias("summary"), F.sum("n_values").alias("n_values")
    )


def summarized_quantile(summaries: DataFrame, share: float, name: str = "quantile", size: int = SIZE) -> DataFrame:
    """Adds the quantile, the values its rank may err to (name_low, name_high) and the rank_error.

    The error is a share of the group's rows. Groups within the summary's size are held whole; the
    interval then covers what the rank's rounding may choose.
    """
    error = rank_error(size)
    at = lambda rank: F.kll_sketch_get_quantile_double("summary", F.lit(min(max(rank, 0.0), 1.0)))
    named: dict[str, Column] = {
        name: at(share),
        f"{name}_low": at(share - error),
        f"{name}_high": at(share + error),
        "rank_error": F.lit(error),
    }
    return summaries.withColumns(named)
