"""Exact neighbour search on vectors that lie in pivot partitions.

Every vector belongs to its nearest pivot. A partition is cut into blocks in the order of the
distance to its pivot, and a block keeps, beside its vectors, the interval of its distances to
every landmark. By the triangle inequality two blocks are at least as far apart as their
intervals are at any landmark, so block pairs are dropped before a vector moves: first pairs of a
query block and a whole partition, then those with the partition's blocks. How far a query block
has to look is known from the nearest partition, which it searches first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmotion.session import scratch_path

BLOCK_ROWS = 512
SAMPLE_ROWS = 2048  # vectors, chosen by a hash, among which pivots are picked
MOST_PIVOTS = 256
LANDMARKS = 16
CHUNK_VALUES = 4_000_000  # distances held at a time in a task
GROUP_BLOCKS = 64  # query blocks of a task
GROUPS_A_CORE = 4  # so that a long task is not waited for
BLOCKS_READ = 8  # corpus blocks a task reads at a time
MERGED = 32  # blocks' nearest rows that a query block gathers before it keeps the k nearest of them
MERGED_ROWS = 3  # or so many times k rows a query
ROOM = 1e-9  # share by which bounds are widened for rounding


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances by differences, so that equal vectors are at 0."""
    out = np.empty((len(left), len(right)))
    step = max(1, 2_000_000 // max(1, right.size))
    for at in range(0, len(left), step):
        gap = left[at : at + step, None, :] - right[None, :, :]
        out[at : at + step] = np.sqrt(np.einsum("lrd,lrd->lr", gap, gap))
    return out


def top_k_positions(queries: np.ndarray, rows: np.ndarray, k: int, within: np.ndarray | None = None) -> tuple:
    """(query position, row position, distance) of each query's k nearest rows.

    A matrix product finds candidates, with room for its rounding error; their distances
    are then taken from differences, so copies are at 0. Ties go to the lower row position. Rows
    farther from a query than its `within` need not be told; a row as far is.
    """
    step = max(1, CHUNK_VALUES // max(len(rows), 1))
    row_norms = np.einsum("nd,nd->n", rows, rows)
    told = np.column_stack([-2.0 * rows, row_norms]).T
    most = 8 * (rows.shape[1] + 4) * np.finfo(float).eps
    found = []
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        norms = np.einsum("qd,qd->q", part, part)
        rough = np.column_stack([part, np.ones(len(part))]) @ told  # the square of the distance but for the query's norm
        if len(rows) > k or within is not None:
            room = most * (norms + row_norms.max())
            limit = np.full(len(part), np.inf)
            if within is not None:
                limit = within[start : start + step] ** 2 * (1 + most) - norms
            open_ = np.flatnonzero(np.isinf(limit)) if len(rows) > k else []
            if len(open_):
                limit[open_] = np.partition(rough[open_], k - 1, axis=1)[:, k - 1]
            q_at, r_at = np.nonzero(rough <= (limit + room)[:, None])
        else:
            q_at, r_at = (a.ravel() for a in np.indices(rough.shape))
        diff = part[q_at] - rows[r_at]
        distance = np.sqrt(np.einsum("nd,nd->n", diff, diff))
        order = np.lexsort((r_at, distance, q_at))
        q_at, r_at, distance = q_at[order], r_at[order], distance[order]
        firsts = np.searchsorted(q_at, np.arange(len(part)))
        keep = np.arange(len(q_at)) - firsts[q_at] < k
        found.append((q_at[keep] + start, r_at[keep], distance[keep]))
    return tuple(np.concatenate(column) for column in zip(*found))


def drawn_in(within: np.ndarray, at: np.ndarray, away: np.ndarray, k: int) -> None:
    """Lower each query's distance to the k-th of the rows it has found; at: ascending, then the distance."""
    last = np.flatnonzero(np.arange(len(at)) - np.searchsorted(at, at) == k - 1)
    within[at[last]] = np.minimum(within[at[last]], away[last])


def spread_points(sample: np.ndarray, n: int) -> np.ndarray:
    """n rows of the sample, each as far from the earlier ones as it can be; distinct rows only."""
    chosen = [0]
    nearest = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def pick_pivots(df: DataFrame, vector: str, rows: int, block_rows: int = BLOCK_ROWS) -> np.ndarray:
    """Pivots for a table of so many rows; the first of them are the landmarks."""
    wanted = int(np.clip(2 * np.sqrt(rows / block_rows), min(LANDMARKS, rows), MOST_PIVOTS))
    order = F.xxhash64(vector)
    sample = df.select(vector).orderBy(order, vector).limit(SAMPLE_ROWS).collect()  # bounded
    return spread_points(np.array([list(r[0]) for r in sample], dtype=np.float64), wanted)


def gap(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    """How far apart two blocks are at least, from their intervals at all landmarks."""
    apart = F.zip_with(
        F.zip_with(lo_a, hi_b, lambda a, b: a - b), F.zip_with(lo_b, hi_a, lambda a, b: a - b), lambda a, b: F.greatest(a, b)
    )
    return F.greatest(F.array_max(apart), F.lit(0.0)) * (1 - ROOM)


@dataclass
class PivotBlocks:
    """Blocks of a table's vectors: part, block, n, lo, hi, ids (structs of the keys) and vecs."""

    pivots: np.ndarray
    path: str
    blocks: DataFrame
    keys: list[str]

    @property
    def intervals(self) -> DataFrame:
        return self.blocks.select("part", "block", "n", "lo", "hi")

    def partitions(self) -> DataFrame:
        """(part, rows, lo, hi) of each pivot's partition: MOST_PIVOTS rows at most."""
        n = min(LANDMARKS, len(self.pivots))
        wide = self.blocks.groupBy("part").agg(
            F.sum("n").alias("rows"),
            *[f(F.col(c)[i]).alias(f"{c}{i}") for c, f in (("lo", F.min), ("hi", F.max)) for i in range(n)],
        )
        return wide.select("part", "rows", *[F.array(*[f"{c}{i}" for i in range(n)]).alias(c) for c in ("lo", "hi")])


def block_vectors(
    df: DataFrame, keys: list[str], vector: str, pivots: np.ndarray, block_rows: int = BLOCK_ROWS, path: str | None = None
) -> PivotBlocks:
    """Cut a table into blocks of vectors and write them. Members of a block stand in key order.

    Vectors are arrays of equally many numbers; rows without one must be left out before.
    """
    spark = df.sparkSession
    landmarks = pivots[: min(LANDMARKS, len(pivots))]
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    rows = df.select(*keys, F.col(vector).cast("array<double>").alias("__vec"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = distances(matrix(batch.column("__vec")), pivots)
            nearest = away.argmin(axis=1)
            marks = away[:, : len(landmarks)]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(marks) + 1) * len(landmarks), pa.int32()), pa.array(marks.ravel())
            )
            columns = [pa.array(nearest.astype(np.int32)), pa.array(away[np.arange(len(away)), nearest]), lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "part", "__away", "__marks"])

    placed_schema = T.StructType(
        [*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("__away", T.DoubleType()),
         T.StructField("__marks", T.ArrayType(T.DoubleType()))]
    )
    placed = rows.mapInArrow(assign, placed_schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, None

        def block(table: pa.Table) -> pa.RecordBatch:
            nonlocal number
            number += 1
            table = table.sort_by([(k, "ascending") for k in keys])
            marks = matrix(table.column("__marks"))
            whole = lambda column: pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
            ids = pa.StructArray.from_arrays([table.column(k).combine_chunks() for k in keys], keys)
            return pa.RecordBatch.from_arrays(
                [table.column("part").combine_chunks()[:1], pa.array([number]), pa.array([table.num_rows]),
                 pa.array([marks.min(axis=0).tolist()]), pa.array([marks.max(axis=0).tolist()]),
                 whole(ids), whole(table.column("__vec").combine_chunks())],
                ["part", "block", "n", "lo", "hi", "ids", "vecs"],
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows:
                part = held.column("part").to_numpy()
                same = int(np.searchsorted(part, part[0], "right"))
                if same == held.num_rows and same < block_rows:
                    break  # it may go on in the next batch
                yield block(held.slice(0, min(same, block_rows)))
                held = held.slice(min(same, block_rows))
        if held is not None and held.num_rows:
            yield block(held)

    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
         *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("lo", "hi")],
         T.StructField("ids", T.ArrayType(T.StructType(fields))),
         T.StructField("vecs", T.ArrayType(T.ArrayType(T.DoubleType())))]
    )
    path = path or scratch_path(spark, "vector-blocks")
    order = ["part", "__away", *keys]
    placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, schema).write.parquet(path)
    return PivotBlocks(pivots, path, spark.read.schema(schema).parquet(path), keys)


def read_blocks(path: str, wanted: dict[int, list[int]]) -> Iterator[tuple[int, pa.StructArray, pa.Array]]:
    """(block, ids, vectors) of the wanted blocks, a few at a time, straight from the stored files."""
    path = "/" + path[len("file:") :].lstrip("/") if path.startswith("file:") else path
    store, base = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
    for name in sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet")):
        with store.open_input_file(name) as opened:
            file = pq.ParquetFile(opened)
            for at in range(file.num_row_groups):
                if wanted.keys().isdisjoint(file.read_row_group(at, ["block"]).column("block").to_pylist()):
                    continue
                for batch in file.iter_batches(BLOCKS_READ, row_groups=[at], columns=["block", "ids", "vecs"]):
                    for i, block in enumerate(batch.column("block").to_pylist()):
                        if block in wanted:
                            yield block, batch.column("ids")[i].values, batch.column("vecs")[i].values


def dealt(rows: DataFrame, column: str, n: int, each: int) -> DataFrame:
    """rows with a `group` by the hash of a column, each group a partition of its own: some `each` of the n rows, and work for every core."""
    spark = rows.sparkSession
    groups = max(1, min(GROUPS_A_CORE * spark.sparkContext.defaultParallelism, n), -(-n // each))
    # Numbers whose hashes fall into the partitions one by one; by chance a few may share one.
    place = F.pmod(F.hash("id"), F.lit(groups))
    told = spark.range(16 * groups).groupBy(place.alias("p")).agg(F.min("id").alias("id")).orderBy("p").collect()  # a row a group
    names = F.array(*[F.lit(r["id"]).cast("long") for r in told])
    numbered = rows.withColumn("group", F.get(names, F.pmod(F.xxhash64(column), F.lit(len(told))).cast("int")))
    return numbered.repartition(groups, "group")


def _bounded_pairs(asked: DataFrame, corpus: PivotBlocks) -> DataFrame:
    """(q_block, block) that lie within the query block's bound, by partitions first."""
    parts = corpus.partitions().select("part", F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"))
    near = asked.join(F.broadcast(parts), gap(F.col("lo"), F.col("hi"), F.col("p_lo"), F.col("p_hi")) <= F.col("bound"))
    near = near.select("q_block", "lo", "hi", "bound", "part")
    blocks = corpus.intervals.select("part", "block", F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    met = near.join(blocks, "part").where(gap(F.col("lo"), F.col("hi"), F.col("b_lo"), F.col("b_hi")) <= F.col("bound"))
    return met.select("q_block", "block")


def nearest_rows(corpus: PivotBlocks, queries: PivotBlocks, k: int) -> tuple[DataFrame, DataFrame]:
    """(candidate rows, block pairs met).

    Candidates are (query id, corpus keys, distance): the k nearest rows of every query are among
    them, at most 2 k rows for each query. queries must have one key and the same pivots.
    """
    spark, keys, (query_id,) = corpus.blocks.sparkSession, corpus.keys, queries.keys
    q_type = queries.blocks.schema["ids"].dataType.elementType[query_id].dataType
    key_fields = corpus.blocks.schema["ids"].dataType.elementType.fields
    schema = T.StructType(
        [T.StructField("q_block", T.LongType()), T.StructField("query_id", q_type), *key_fields, T.StructField("distance", T.DoubleType())]
    )

    stored, names = corpus.path, list(schema.names)
    order = [("at", "ascending"), ("distance", "ascending"), *[(k, "ascending") for k in keys]]

    def nearest(found: list[pa.Table]) -> list[pa.Table]:
        """The k nearest of each query, ties by key."""
        table = pa.concat_tables(found)
        table = table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_start"))
        at = table.column("at").to_numpy()
        return [table.filter(pa.array(np.arange(len(at)) - np.searchsorted(at, at) < k))]

    def search(group: pa.Table) -> pa.Table:
        """A group of query blocks: the corpus blocks they ask for pass by once, read from the shared folder."""
        asked, vectors = group.column("q_ids").to_pylist(), group.column("q_vecs")
        asking: dict[int, list[int]] = {}
        for i, blocks in enumerate(group.column("blocks")):
            for block in blocks.as_py():
                asking.setdefault(block, []).append(i)
        q_vecs = [matrix(v.values) for v in vectors]
        best: list[list[pa.Table]] = [[] for _ in q_vecs]
        within = [np.full(len(v), np.inf) for v in q_vecs]  # no k-th nearest row is farther
        for block, ids, vecs in read_blocks(stored, asking):
            rows = matrix(vecs)
            for i in asking[block]:
                at, row, away = top_k_positions(q_vecs[i], rows, k, within[i])
                if best[i] and not len(at):
                    continue
                drawn_in(within[i], at, away, k)
                columns = [pa.array(at), pa.array(away), *ids.take(pa.array(row)).flatten()]
                best[i].append(pa.Table.from_arrays(columns, ["at", "distance", *keys]))
                if len(best[i]) >= MERGED or sum(t.num_rows for t in best[i]) > MERGED_ROWS * k * len(q_vecs[i]):
                    best[i] = nearest(best[i])
                    drawn_in(within[i], best[i][0].column("at").to_numpy(), best[i][0].column("distance").to_numpy(), k)
        out = []
        for i, found in enumerate(best):
            (table,) = nearest(found)
            ids = pa.array([r[query_id] for r in asked[i]], group.schema.field("q_ids").type.value_type.field(query_id).type)
            block = pa.array(np.full(table.num_rows, group.column("q_block")[i].as_py()))
            out.append(
                pa.Table.from_arrays(
                    [block, ids.take(table.column("at").combine_chunks()), *[table.column(c) for c in keys], table.column("distance")], names
                )
            )
        return pa.concat_tables(out)

    n_blocks = queries.blocks.count()

    def met(pairs: DataFrame) -> DataFrame:
        # Only numbers of blocks and each query block, once, are shuffled.
        asked = queries.blocks.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"))
        both = pairs.groupBy("q_block").agg(F.collect_list("block").alias("blocks")).join(asked, "q_block")
        both = dealt(both, "q_block", n_blocks, GROUP_BLOCKS)
        path = scratch_path(spark, "neighbours")
        both.groupBy("group").applyInArrow(search, schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    asked = queries.intervals.select(F.col("block").alias("q_block"), F.col("part").alias("q_part"), F.col("n").alias("q_n"), "lo", "hi")
    parts = corpus.partitions().select("part", "rows", F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"))
    # Every query finds k rows in a partition that holds so many, no farther than over a landmark.
    through = F.array_min(F.zip_with("hi", "p_hi", lambda a, b: a + b)) * (1 + ROOM)
    rated = asked.join(F.broadcast(parts), F.lit(True)).select(
        "*", gap(F.col("lo"), F.col("hi"), F.col("p_lo"), F.col("p_hi")).alias("gap"), F.when(F.col("rows") >= k, through).alias("through")
    )
    first = rated.groupBy("q_block").agg(
        F.min("through").alias("through"), F.min(F.struct("gap", F.abs(F.col("part") - F.col("q_part")).alias("other"), "part")).alias("own")
    )
    path = scratch_path(spark, "query-bounds")
    asked.join(first, "q_block").select("q_block", "q_n", "lo", "hi", "through", F.col("own.part").alias("part")).write.parquet(path)
    asked = spark.read.parquet(path)
    # The nearest partition's nearest blocks give each query a k-th distance to start with.
    own = asked.join(corpus.intervals.select("part", "block", "n", F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi")), "part")
    own = own.where(gap(F.col("lo"), F.col("hi"), F.col("b_lo"), F.col("b_hi")) <= F.coalesce("through", F.lit(float("inf"))))
    opened = own.select("q_block", "block")
    opening = met(opened)
    nth = Window.partitionBy("q_block", "query_id").orderBy("distance")
    known = opening.withColumn("__n", F.row_number().over(nth)).where(F.col("__n") == k)
    reach = known.groupBy("q_block").agg(F.count(F.lit(1)).alias("answered"), F.max("distance").alias("reach"))
    infinite = F.lit(float("inf"))
    known = F.when(F.col("answered") >= F.col("q_n"), F.coalesce("reach", infinite)).otherwise(infinite)
    bound = F.least(F.coalesce("through", infinite), F.coalesce(known, infinite)) * (1 + ROOM)
    wide = asked.drop("part").join(reach, "q_block", "left").withColumn("bound", bound)
    pairs = _bounded_pairs(wide.select("q_block", "lo", "hi", "bound"), corpus)
    path = scratch_path(spark, "block-pairs")
    pairs.union(opened).distinct().write.parquet(path)
    pairs = spark.read.parquet(path)
    rest = met(pairs.join(opened, ["q_block", "block"], "left_anti"))
    return opening.union(rest).drop("q_block"), pairs


def share_met(pairs: DataFrame, corpus: PivotBlocks, queries: PivotBlocks) -> float:
    """Share of all pairs of a query block and a corpus block that were compared."""
    return pairs.count() / max(1, corpus.blocks.count() * queries.blocks.count())
