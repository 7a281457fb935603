"""Exact search for the largest inner products, with pruning that loses nothing.

Vectors are dealt into blocks by descending length. A rotation by the corpus's singular vectors
moves most of a vector's length into its first coordinates. A block of queries meets blocks of
vectors from the longest down; the partial product over the first coordinates plus the product
of the residual lengths bounds the score (Cauchy-Schwarz), and only pairs whose bound reaches
the query's current k-th score are scored, exactly, in whole numbers. What the longest vectors
score first gives every query a floor, and blocks too short to reach it are never sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.llm.common import stored

SCALE = 64
K = 20
QUERY_BLOCK, VECTOR_BLOCK = 2048, 4096
LEAD = 16  # rotated coordinates of the partial product
EXACT = 2**53  # whole numbers up to here are exact as doubles
HUGE = 2.0**500  # components count as no more than this where lengths are bounded
LONG = 2**63 - 1
TILE = 512


def whole_vectors(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array of whole numbers as doubles) of the rows that take part.

    A vector takes no part if it or a component is null or not finite (after scaling too), or if
    its vec_id is null. Rows that share a vec_id all take part.
    """
    scaled = lambda c: c.cast("double") * scale
    # Doubles from 2^53 on are whole already, and might not fit the long that floor gives.
    x = F.transform("embedding", lambda c: F.when(F.abs(scaled(c)) >= float(EXACT), scaled(c)).otherwise(F.floor(scaled(c)).cast("double")))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    rows = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    good = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < float("inf")))
    return rows.where(F.coalesce(good, F.lit(False))).select("vec_id", x.alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """List column as a matrix; shorter vectors are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int32()))
    length = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), length)
    at = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    out[row, at] = column.flatten().to_numpy()
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Singular vectors of the corpus, the strongest first, from its Gram matrix."""

    def run(batches):
        gram = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("v"), width)
            # Directions only: very long vectors are shortened so that no product overflows.
            m = m / np.maximum(1.0, np.abs(m).max(axis=1, initial=0, keepdims=True) / 2.0**100)
            gram += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary())], ["gram"])

    gram = np.zeros((width, width))
    for row in vectors.select("v").mapInArrow(run, "gram binary").toLocalIterator():
        gram += np.frombuffer(row["gram"]).reshape(width, width)  # width x width a task
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _search(queries: pa.Table, vectors: pa.Table, basis: np.ndarray, k: int) -> pa.Table:
    """The k best of a block of vectors for each query, or fewer if no more reach its floor."""
    width = len(basis)
    lead = min(LEAD, width)
    q_id, v_id = queries.column("query_id").to_numpy(), vectors.column("vec_id").to_numpy()
    q_whole, v_whole = _matrix(queries.column("q"), width), _matrix(vectors.column("v"), width)
    q, v = np.clip(q_whole, -HUGE, HUGE), np.clip(v_whole, -HUGE, HUGE)  # for bounds
    order = np.lexsort((v_id, -np.einsum("ij,ij->i", v, v)))
    v, v_whole, v_id = v[order], v_whole[order], v_id[order]
    floor = queries.column("floor").to_numpy().astype(float)
    q_lead, v_lead = q @ basis[:, :lead], v @ basis[:, :lead]
    rest = lambda m, led: np.sqrt(np.maximum(np.einsum("ij,ij->i", m, m) - np.einsum("ij,ij->i", led, led), 0))
    q_rest, v_rest = rest(q, q_lead), rest(v, v_lead)
    q_norm, v_norm = np.sqrt(np.einsum("ij,ij->i", q, q)), np.sqrt(np.einsum("ij,ij->i", v, v))
    slack = 1e-9 * (q_norm * (v_norm[0] if len(v) else 0)) + 1e-6  # covers rounding in the bounds
    best = np.full((len(q), k), -np.inf)  # scores so far, to raise the floor
    found_q, found_v, found_s = [], [], []
    for at in range(0, len(v), TILE):
        tile = slice(at, at + TILE)
        alive = np.flatnonzero(q_norm * v_norm[at] + slack >= floor)
        if not len(alive):
            break
        bound = q_lead[alive] @ v_lead[tile].T + np.outer(q_rest[alive], v_rest[tile])
        row, col = np.nonzero(bound + slack[alive, None] >= floor[alive, None])
        if not len(row):
            continue
        mine, theirs = alive[row], at + col
        if len(row) * 4 > bound.size:
            # Whole numbers below 2^53: the product is exact, else it is done in 64-bit integers.
            score = _exact(q_whole[alive], v_whole[tile])[row, col]
        else:
            score = _pairs(q_whole, v_whole, mine, theirs)
        keep = (score >= floor[mine]) & (q_id[mine] != v_id[theirs])
        mine, theirs, score = mine[keep], theirs[keep], score[keep]
        found_q.append(mine)
        found_v.append(v_id[theirs])
        found_s.append(score)
        rank = np.lexsort((-score, mine))
        mine, score = mine[rank], score[rank]
        place = np.arange(len(mine)) - np.searchsorted(mine, mine)
        top = place < k
        merged = np.full((len(q), 2 * k), -np.inf)
        merged[:, :k] = best
        merged[mine[top], k + place[top]] = score[top]
        best = -np.sort(-merged, axis=1)[:, :k]
        floor = np.maximum(floor, best[:, k - 1])
    join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
    mine, ids, score = join(found_q, np.int64), join(found_v, np.int64), join(found_s, np.int64)
    rank = np.lexsort((ids, -score, mine))
    mine, ids, score = mine[rank], ids[rank], score[rank]
    top = np.arange(len(mine)) - np.searchsorted(mine, mine) < k
    return pa.table([pa.array(q_id[mine[top]]), pa.array(ids[top]), pa.array(score[top])], ["query_id", "vec_id", "score"])


def _product_fits(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]


def _as_longs(scores: np.ndarray) -> np.ndarray:
    return np.array([max(-LONG - 1, min(LONG, v)) for v in scores.ravel().tolist()], np.int64).reshape(scores.shape)


def _whole(m: np.ndarray) -> np.ndarray:
    """Python's own integers, for products beyond 64 bits."""
    return np.array([int(v) for v in m.ravel().tolist()], object).reshape(m.shape)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows as 64-bit integers; beyond those, the nearest one."""
    most = _product_fits(a, b)
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return _as_longs(_whole(a) @ _whole(b).T)


def _pairs(q: np.ndarray, v: np.ndarray, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    out = np.empty(len(mine), np.int64)
    for at in range(0, len(mine), 65536):
        part = slice(at, at + 65536)
        a, b = q[mine[part]], v[theirs[part]]
        if _product_fits(a, b) < 2**62:
            out[part] = np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
        else:
            out[part] = _as_longs((_whole(a) * _whole(b)).sum(axis=1))
    return out


HITS = "query_id long, vec_id long, score long"


def top_k(embeddings: DataFrame, every: int = 20, k: int = K, scale: int = SCALE) -> DataFrame:
    """The k best partners of each vector whose vec_id `every` divides: rank, vec_id, score.

    Ties go to the smaller vec_id; a score beyond 64 bits counts as the nearest 64-bit number; a
    vec_id of several rows is one query with the best pairs of all of them, and each of them a
    candidate (not for each other); a query with fewer partners has fewer rows; vectors of
    unequal width are compared as if filled up with zeros; which rows take part is said at
    `whole_vectors`. Other columns are ignored; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    vectors = stored(
        whole_vectors(embeddings, scale).withColumn(
            "norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + F.least(F.abs(c), F.lit(HUGE)) * F.least(F.abs(c), F.lit(HUGE)))
        ),
        "vectors",
    )
    total, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not total or not width:
        width = width or 1
    basis = rotation(vectors, width)
    # Blocks by descending length: the bounds come from a sketch of the lengths, and ids split
    # a run of equal lengths, so a block holds about VECTOR_BLOCK rows whatever the data.
    ranges = max(1, -(-total // VECTOR_BLOCK))
    dealt = vectors.repartitionByRange(ranges, F.desc("norm2"), "vec_id").withColumn("block", F.spark_partition_id())
    dealt = stored(dealt, "vector-blocks")
    tops = sorted(
        ((r["block"], r["top"]) for r in dealt.groupBy("block").agg(F.max("norm2").alias("top")).collect())
    )  # a row a block
    queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = max(1, -(-(total // every + 1) // QUERY_BLOCK))
    queries = queries.select(
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("q"),
        F.sqrt("norm2").alias("q_norm"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("q_block"),
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search(left, right, basis, k)

    def against(asked: DataFrame, corpus: DataFrame) -> DataFrame:
        """Every listed pair of a query block and a vector block is a task of its own."""
        pairs = corpus.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return asked.groupBy("q_block", "block").cogroup(pairs.groupBy("q_block", "block")).applyInArrow(search, HITS)

    first = tops[0][0] if tops else 0
    lowest = -float(2**62)
    opening = stored(
        against(
            queries.select("query_id", "q", "q_block", F.lit(first).alias("block"), F.lit(lowest).alias("floor")),
            dealt.where(F.col("block") == first).select("vec_id", "v", "block"),
        ),
        "opening",
    )
    nth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = opening.withColumn("n", F.row_number().over(nth)).where(F.col("n") == k).select("query_id", F.col("score").alias("s"))
    asked = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce(F.col("s").cast("double"), F.lit(lowest)))
    # Block lengths fall, so the blocks a query can still use are the first ones of this list.
    lengths = F.array(*[F.lit(float(t) ** 0.5) for b, t in tops if b != first] or [F.lit(-1.0)])
    useful = F.size(F.filter(lengths, lambda t: F.col("q_norm") * t * (1 + 1e-9) + 1e-6 >= F.col("floor")))
    numbers = F.array(*[F.lit(b) for b, _ in tops if b != first] or [F.lit(-1)])
    sent = asked.withColumn("block", F.explode(F.slice(numbers, 1, useful)))
    rest = against(
        sent.select("query_id", "q", "q_block", "block", "floor"),
        dealt.where(F.col("block") != first).select("vec_id", "v", "block"),
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = opening.union(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
