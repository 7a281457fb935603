"""Seeded samples and splits from key digests: stable across runs, engines and layouts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.functions.scalars import key_digest, key_fraction, key_number
from gridmotion.operators.joins import restrict_to_keys
from gridmotion.schemas import PLAY_KEYS, TIMELINE_KEYS


BORDER_ROWS = 100_000  # keys that may be ordered to find the last of a sample
_DIGITS = 3  # hex digits by which the histogram grows finer


def sample_keys(
    df: DataFrame, n: int, keys: list[str] = TIMELINE_KEYS, seed: int = 42, border_rows: int = BORDER_ROWS
) -> DataFrame:
    """The n distinct keys that come first in digest order (all, if there are fewer).

    A histogram of the digests' first digits says up to where all keys are taken; only the keys
    that share the digits at the border are ordered. So n may be any share of the table.
    """
    distinct = df.select(*keys).distinct().withColumn("__digest", key_digest(keys, seed))
    border, missing = "", n
    while True:
        digits = len(border) + _DIGITS
        prefix = F.substring("__digest", 1, digits)
        near = distinct.where(F.startswith("__digest", F.lit(border))) if border else distinct
        counts = near.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()  # 16^3 at most
        size = 0
        for r in counts:
            size = r["n"]
            if missing <= size:
                border = r["p"]
                break
            missing -= size
        else:
            return distinct.drop("__digest")
        if size <= border_rows or digits >= 32:
            break
    before = distinct.where(F.substring("__digest", 1, len(border)) < border)
    at = distinct.where(F.startswith("__digest", F.lit(border)))
    order = Window.partitionBy(F.substring("__digest", 1, len(border))).orderBy("__digest", *keys)
    last = at.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= missing).drop("__n")
    return before.unionByName(last).drop("__digest")


def sample_sequences(
    df: DataFrame, n: int, keys: list[str] = TIMELINE_KEYS, seed: int = 42
) -> DataFrame:
    """All rows of n sampled sequences."""
    return restrict_to_keys(df, sample_keys(df, n, keys, seed), keys)


def split_column(
    df: DataFrame,
    shares: dict[str, float],
    keys: list[str] = PLAY_KEYS,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Label every row with its part; all rows of a key share one part, so nothing leaks."""
    if not math.isclose(sum(shares.values()), 1.0):
        raise ValueError("split shares must sum to 1")
    *rest, last = shares
    fraction = key_fraction(keys, seed)
    label, upto = F.lit(last), 0.0
    bounds = []
    for part in rest:
        upto += shares[part]
        bounds.append((part, upto))
    for part, bound in reversed(bounds):
        label = F.when(fraction < bound, part).otherwise(label)
    return df.withColumn(name, label)


def train_val_test(df: DataFrame, train=0.7, val=0.15, test=0.15, **options) -> DataFrame:
    return split_column(df, {"train": train, "val": val, "test": test}, **options)


def train_test(df: DataFrame, test=0.2, **options) -> DataFrame:
    return split_column(df, {"train": 1.0 - test, "test": test}, **options)


def fold_column(
    df: DataFrame, k: int, keys: list[str] = TIMELINE_KEYS, seed: int = 42, name: str = "fold"
) -> DataFrame:
    return df.withColumn(name, (key_number(keys, seed) % k).cast("int"))


def cluster_examples(
    df: DataFrame, cluster: int, n: int = 10, keys: list[str] = ("game_id", "play_id", "player_side")
) -> DataFrame:
    """The first n rows of one cluster in key order."""
    return df.where(F.col("cluster") == cluster).orderBy(*keys).limit(n)
