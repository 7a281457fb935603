"""Exact k-nearest-neighbour search over vector tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmotion.operators.pivots import block_vectors, nearest_rows, pick_pivots, top_k_positions
from gridmotion.operators.quality import assert_not_empty
from gridmotion.operators.sequences import formation_matrix
from gridmotion.operators.skew import dense_index
from gridmotion.schemas import SIDE_KEYS

# Query values (rows x dimensions) that may travel to every task: 16 MB of doubles.
MAX_SHIPPED_VALUES = 2_000_000


def distance_to(vector: str, point: list[float]) -> Column:
    """Euclidean distance of an array column to a fixed point, as generated code."""
    total = F.lit(0.0)
    for i, value in enumerate(point):
        diff = F.get(F.col(vector), F.lit(i)).cast("double") - F.lit(float(value))
        total = total + diff * diff
    return F.sqrt(total)


def nearest_to_point(
    corpus: DataFrame, point: list[float], k: int, keys: list[str], vector: str = "vector"
) -> DataFrame:
    """The k nearest rows, ties by key: one scan, each task forwards k rows."""
    ranked = corpus.withColumn("distance", distance_to(vector, point))
    return ranked.orderBy("distance", *keys).limit(k).select(*keys, "distance")


def nearest_by_key(
    corpus: DataFrame, key: dict, k: int = 5, vector: str = "vector"
) -> DataFrame:
    """Neighbours of the row with the given key, itself at distance 0."""
    chosen = corpus
    for name, value in key.items():
        chosen = chosen.where(F.col(name) == value)
    row = chosen.select(vector).first()
    if row is None:
        raise ValueError(f"no formation for {key}")
    return nearest_to_point(corpus, list(row[0]), k, list(key), vector)


def nearest_by_index(
    corpus: DataFrame, idx: int, k: int = 5, keys: list[str] = SIDE_KEYS, vector: str = "vector"
) -> DataFrame:
    """Neighbours of the idx-th row in key order."""
    row = dense_index(corpus.select(*keys, vector), keys).where(F.col("idx") == idx).first()
    if row is None:
        raise ValueError(f"no formation at index {idx}")
    return nearest_to_point(corpus, list(row[vector]), k, keys, vector)


# ------------------------------------------------------------- many queries at once


def _matrix(vectors) -> np.ndarray:
    return np.stack(vectors).astype(np.float64)


def _scan_kernel(query_ids, query_matrix, keys: list[str], vector: str, k: int):
    """Per partition: best k rows of each query, refreshed batch by batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: pd.DataFrame | None = None
        for batch in batches:
            if batch.empty:
                continue
            batch = batch.sort_values(keys)
            q_at, r_at, distance = top_k_positions(query_matrix, _matrix(batch[vector].to_numpy()), k)
            fresh = batch[keys].iloc[r_at].assign(__q=q_at, distance=distance)
            if best is not None:
                fresh = pd.concat([best, fresh]).sort_values(["__q", "distance", *keys])
                fresh = fresh.groupby("__q", sort=False).head(k)
            best = fresh
        if best is not None:
            ids = [query_ids[i] for i in best.pop("__q")]
            best.insert(0, "query_id", ids)
            yield best

    return run


def knn(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    keys: list[str],
    query_id: str,
    vector: str = "vector",
    max_shipped_values: int = MAX_SHIPPED_VALUES,
) -> DataFrame:
    """The k nearest corpus rows of every query: (query_id, *keys, distance, rank).

    A query set within max_shipped_values goes to every task and the corpus is scanned once
    without a shuffle. A larger one is cut into blocks that meet the corpus blocks within their
    reach (see `pivots`). Either way a task emits at most k rows per query and block, never the
    pairs.
    """
    query_type = queries.schema[query_id].dataType
    fields = [T.StructField("query_id", query_type)]
    fields += [T.StructField(c, corpus.schema[c].dataType) for c in keys]
    schema = T.StructType([*fields, T.StructField("distance", T.DoubleType())])
    wanted = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("v"))
    sizes = wanted.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    slim = corpus.select(*keys, vector)
    if (sizes.n or 0) * (sizes.d or 0) <= max_shipped_values:
        shipped = wanted.collect()  # at most max_shipped_values numbers
        if not shipped:
            return corpus.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0))
        ids = [r.query_id for r in shipped]
        matrix = np.array([r.v for r in shipped], dtype=np.float64)
        partial = slim.mapInPandas(_scan_kernel(ids, matrix, keys, vector, k), schema)
    else:
        partial = _knn_by_blocks(slim, wanted, keys, vector, k)
    ranking = Window.partitionBy("query_id").orderBy("distance", *keys)
    return partial.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)


def _knn_by_blocks(slim, wanted, keys, vector, k) -> DataFrame:
    """Query blocks meet the corpus blocks that the pivots leave within their reach."""
    rows = slim.where(F.col(vector).isNotNull())
    total = rows.count()
    if not total:
        return rows.select(F.lit(None).cast(wanted.schema["query_id"].dataType).alias("query_id"), *keys, F.lit(0.0).alias("distance"))
    pivots = pick_pivots(rows, vector, total)
    corpus = block_vectors(rows, keys, vector, pivots)
    queries = block_vectors(wanted.where("v IS NOT NULL"), ["query_id"], "v", pivots)
    return nearest_rows(corpus, queries, k)[0]


# ------------------------------------------------------------- stored formation index


def save_formation_index(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").parquet(path)


def load_formation_index(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def build_formation_index(
    players: DataFrame, side: str | None = None, save_path: str | None = None
) -> DataFrame:
    """Formation vectors ready for neighbour search, stored when a path is given.

    Storing an index without rows, as for a side nobody plays on, is an error.
    """
    index = formation_matrix(players, side).select(*SIDE_KEYS, "vector")
    if save_path is None:
        return index
    assert_not_empty(index, f"formations of side {side or 'any'}")
    save_formation_index(index, save_path)
    return load_formation_index(players.sparkSession, save_path)
