"""Approximate neighbour search by random projections.

A table of the index cuts the vectors in two at the middle of each of its random directions; the
sides of all its directions make a bucket's code. A query looks into its own bucket and into those
on the other side of the directions it lies closest to (multi-probe), in several tables. How many
buckets it must look into is measured when the index is fitted: on a bounded sample of the
vectors, against an exact search.

Copies of a vector are one entry with its first keys, so they fill no bucket. What makes a bucket
large otherwise passes by in pieces. The index is stored once, in the order of its buckets; a task
holds a group of queries, reads the stored index past them and emits at most k entries per query.
Candidates are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmotion.operators.pivots import dealt, drawn_in, matrix, top_k_positions
from gridmotion.operators.skew import dense_index
from gridmotion.session import scratch_path

TABLES = 6
BUCKET_ROWS = 256  # a bucket's size that the number of directions aims at
PIECE_ROWS = 2048
GROUP_QUERIES, LEAST_QUERIES = 8192, 256  # queries of a task at most and, where cores are idle, at least
PROBES_HELD = 4_000_000  # codes a task's queries look into in one table
PROBED_AT_ONCE = 512  # queries whose probes are ranked at a time
FOUND_HELD = 1_000_000  # found rows a task gathers before it keeps the k nearest of each query
FIT_ROWS, FIT_QUERIES = 4096, 256  # sample the cuts and the number of probes are fitted on
NEAR_BITS = 12  # directions a probe may cross: those the query lies closest to
TARGET = 0.95  # recall on the sample, so that 0.9 holds on all rows


@dataclass
class ProjectionIndex:
    directions: np.ndarray  # tables x bits x dimensions
    cuts: np.ndarray  # tables x bits
    probes: int
    sample_recall: float

    def sides(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """(code, distance to each cut) of the vectors in one table."""
        away = vectors @ self.directions[table].T - self.cuts[table]
        bits = away.shape[1]
        return ((away >= 0) << np.arange(bits)).sum(axis=1).astype(np.int64), np.abs(away)

    def probed(self, vectors: np.ndarray, table: int, ordered: bool = True) -> np.ndarray:
        """Codes to look into, row by row; if ordered, the nearest first."""
        code, away = self.sides(vectors, table)
        bits = away.shape[1]
        near = np.argsort(away, axis=1, kind="stable")[:, : min(NEAR_BITS, bits)]
        flips = [c for n in range(near.shape[1] + 1) for c in combinations(range(near.shape[1]), n)]
        chosen = np.zeros((len(flips), near.shape[1]), bool)
        for i, c in enumerate(flips):
            chosen[i, list(c)] = True
        cost = (np.take_along_axis(away, near, 1) ** 2) @ chosen.T
        if ordered or self.probes == cost.shape[1]:
            first = np.argsort(cost, axis=1, kind="stable")[:, : self.probes]
        else:
            first = np.argpartition(cost, self.probes - 1, axis=1)[:, : self.probes]
        masks = np.stack([np.where(c, 1, 0) for c in chosen])
        bit = np.left_shift(1, near.astype(np.int64))
        return code[:, None] ^ np.einsum("qpb,qb->qp", masks[first], bit)


def fit_projections(
    df: DataFrame, vector: str, k: int, rows: int, tables: int = TABLES, target: float = TARGET, seed: int = 42
) -> ProjectionIndex:
    """Directions, cuts and number of probes for a table of so many rows, from a sample of it."""
    order = F.xxhash64(F.lit(seed), vector)
    sample = df.select(vector).where(F.col(vector).isNotNull()).distinct().orderBy(order, vector).limit(FIT_ROWS)
    points = np.array([list(r[0]) for r in sample.collect()], dtype=np.float64)  # bounded
    if not len(points):
        raise ValueError("no vectors to fit an index on")
    bits = int(np.clip(np.ceil(np.log2(max(1.0, rows / BUCKET_ROWS))), 1, 24))
    directions = np.random.default_rng(seed).normal(size=(tables, bits, points.shape[1]))
    cuts = np.median(np.einsum("tbd,nd->tbn", directions, points), axis=2)
    most = 2 ** min(NEAR_BITS, bits)
    index = ProjectionIndex(directions, cuts, most, 1.0)
    asked = points[:FIT_QUERIES]
    at, near, _ = top_k_positions(asked, points, k)
    # For each true neighbour, how many probes it takes in the table that finds it first.
    needed = np.full(len(at), most + 1)
    for t in range(tables):
        code, _ = index.sides(points, t)
        hit = index.probed(asked, t)[at] == code[near][:, None]
        needed = np.minimum(needed, np.where(hit.any(axis=1), hit.argmax(axis=1) + 1, most + 1))
    probes = int(np.clip(np.sort(needed)[int(np.ceil(target * len(needed))) - 1], 1, most))
    return replace(index, probes=probes, sample_recall=float((needed <= probes).mean()))


def _coded(df: DataFrame, vector: str, index: ProjectionIndex) -> DataFrame:
    """Every row once for each table's bucket it lies in: columns, table and code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column(vector))
            for t in range(len(index.directions)):
                codes = index.sides(vectors, t)[0]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.full(codes.size, t, np.int32)), pa.array(codes)], [*batch.schema.names, "table", "code"]
                )

    schema = T.StructType([*df.schema.fields, T.StructField("table", T.IntegerType()), T.StructField("code", T.LongType())])
    return df.mapInArrow(run, schema)


def _entries(path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(table, codes, entries, vectors) of the stored index, a piece at a time, in the order of table and code."""
    path = "/" + path[len("file:") :].lstrip("/") if path.startswith("file:") else path
    store, base = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
    for name in sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet")):
        with store.open_input_file(name) as opened:
            for batch in pq.ParquetFile(opened).iter_batches(PIECE_ROWS, columns=["table", "code", "n", "vec"]):
                tables, codes, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("table", "code", "n"))
                vectors = matrix(batch.column("vec"))
                for t in np.unique(tables).tolist():
                    mine = tables == t
                    yield t, codes[mine], n[mine], vectors[mine]


def _search(path: str, index: ProjectionIndex, k: int):
    """A group of queries: the index passes by once, read from the shared folder."""

    def kept(found: list[tuple]) -> tuple:
        """The k nearest entries of each query, each entry once."""
        at, n, away = map(np.concatenate, zip(*found))
        order = np.lexsort((n, away, at))
        at, n, away = at[order], n[order], away[order]
        once = np.lexsort((np.arange(len(at)), n, at))  # an entry of several tables has one distance
        again = np.zeros(len(at), bool)
        again[once[1:]] = (at[once[1:]] == at[once[:-1]]) & (n[once[1:]] == n[once[:-1]])
        at, n, away = at[~again], n[~again], away[~again]
        near = np.arange(len(at)) - np.searchsorted(at, at) < k
        return at[near], n[near], away[near]

    def search(group: pa.Table) -> pa.Table:
        asked = matrix(group.column("vec"))
        within = np.full(len(asked), np.inf)  # no k-th nearest entry is farther
        found, held, now = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0, None
        for t, codes, n, vectors in _entries(path):
            if t != now:
                now = t
                probed = np.concatenate([index.probed(asked[i : i + PROBED_AT_ONCE], t, False).astype(np.int32) for i in range(0, len(asked), PROBED_AT_ONCE)])
                who = np.argsort(probed.ravel(), kind="stable")
                line = probed.ravel()[who]
                who = (who // probed.shape[1]).astype(np.int32)
            edges = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1], True])
            first, last = np.searchsorted(line, codes[edges[:-1]], "left"), np.searchsorted(line, codes[edges[:-1]], "right")
            for lo, hi, x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), first.tolist(), last.tolist()):
                if x == y:
                    continue
                mine = who[x:y]
                near = within[mine]
                at, row, away = top_k_positions(asked[mine], vectors[lo:hi], k, near)
                drawn_in(near, at, away, k)
                within[mine] = near  # a query looks into a bucket once
                found.append((mine[at].astype(np.int64), n[lo:hi][row], away))
                held += len(at)
            if held > FOUND_HELD:
                found, held = [kept(found)], 0
                drawn_in(within, found[0][0], found[0][2], k)
        at, n, away = kept(found)
        return pa.Table.from_arrays([group.column("qid").take(pa.array(at)), pa.array(n), pa.array(away)], ["qid", "n", "distance"])

    return search


def _one_each(df: DataFrame, keys: list[str], vector: str, k: int) -> DataFrame:
    """(vec, ids): distinct vectors with the first k of their keys."""
    rows = df.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("vec"), F.struct(*keys).alias("id"))
    first = Window.partitionBy("vec").orderBy("id")
    rows = rows.withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= k)
    return rows.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def approximate_knn(
    corpus: DataFrame, queries: DataFrame, k: int, keys: list[str], query_id: str, vector: str, index: ProjectionIndex
) -> DataFrame:
    """(query_id, *keys, distance, rank): the nearest of the rows in the buckets a query looks into.

    Distances are exact, ties go by key; a query whose buckets hold fewer than k rows has fewer.
    """
    spark = corpus.sparkSession
    entries = dense_index(_stored(_one_each(corpus, keys, vector, k), "corpus-vectors"), ["ids"], "n")
    held = _stored(entries.select("n", "ids", "vec"), "entries")
    asked = _stored(
        queries.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("vec"), F.col(query_id).alias("query_id")),
        "queries",
    )
    distinct = _stored(asked.groupBy("vec").agg(F.min("query_id").alias("qid")), "asked")
    # The index is stored once, in the order of its buckets; queries never travel by probe.
    path, order = scratch_path(spark, "index"), ["table", "code", "n"]
    _coded(held.select("n", "vec"), "vec", index).repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    each = int(np.clip(PROBES_HELD // index.probes, 256, GROUP_QUERIES))
    groups = dealt(distinct, "vec", -(-distinct.count() // LEAST_QUERIES), max(1, each // LEAST_QUERIES))
    schema = T.StructType([T.StructField("qid", asked.schema["query_id"].dataType), T.StructField("n", T.LongType()), T.StructField("distance", T.DoubleType())])
    met = _stored(groups.groupBy("group").applyInArrow(_search(path, index, k), schema), "met")
    found = met.join(held.select("n", "ids"), "n").select("qid", "distance", F.explode("ids").alias("id"))
    best = Window.partitionBy("qid").orderBy("distance", "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    ranked = _stored(ranked, "ranked")
    # Queries of equal vectors share their answers.
    named = asked.join(distinct, "vec").select("query_id", "qid")
    return named.join(ranked, "qid").select("query_id", *[F.col(f"id.{c}").alias(c) for c in keys], "distance", "rank")


def recall(found: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    """(n_exact, n_found): neighbours of the exact result, and how many of them were found.

    A neighbour as near as the last exact one counts as found, since ties are any one's.
    """
    last = exact.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("last"))
    near = found.join(last, "query_id").where(F.col("distance") <= F.col("last") * (1 + 1e-9) + 1e-12)
    hits = near.groupBy("query_id").agg(F.least(F.count(F.lit(1)), F.first("n")).alias("hit"))
    both = last.join(hits, "query_id", "left")
    return both.agg(F.sum("n").alias("n_exact"), F.sum(F.coalesce("hit", F.lit(0))).alias("n_found"))
