"""Ranked lexical search over an index that is grouped by a document's length normaliser.

The normaliser m is a whole number, and how much an occurrence count tf of a term adds to a score
depends on tf and m alone. So documents of equal m form a stratum, a stratum's postings list, for
each term and each tf, the documents, and an impact is computed once for each tf of a stratum.
The largest tf of every query term bounds what any document of a stratum can score. The strata
with the best bounds are searched first; the scores found there are floors, and only strata whose
bound reaches a query's floor are visited for it afterwards, in the order of their bounds.

The index holds postings of the terms that are asked for. Strata are cut into pieces of bounded
size, so a very common length is many tasks' work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.llm.common import slices, stored

K = 10
PIECE_ROWS = 1024  # documents of a stratum's piece
ASKED_AT_ONCE = 500_000  # (item, term) pairs sent to every task; more items are searched in several passes
PAIRS_AT_ONCE = 4_000_000  # contributions held at a time in a task
KEYS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)  # A-Z to a-z; anything but digits, letters and non-ASCII bytes parts terms


def terms_of(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order."""
    return raw.translate(KEYS).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def normaliser(n: int, total: int) -> Column:
    return (F.lit(25) + F.expr(f"(75L * n * {n}L) div {max(1, total)}L")).cast("long")


def impacts(tf: np.ndarray, m: int | np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _raw(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def asked_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of the queries; rows that share an item_id are one query, equal rows count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [terms_of(raw) for raw in _raw(part.column("text"))]
                ids = np.repeat(np.arange(part.num_rows), [len(f) for f in found])
                terms = pa.array([t for f in found for t in f], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(ids)), terms], ["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = rows.distinct().mapInArrow(run, "item_id long, term binary")
    return found.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


DOCUMENT = "row long, doc_id long, n long, terms array<int>, tfs array<int>"


def _documents(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """DOCUMENT rows: how many terms a document has, and which asked ones how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, number = vocabulary.get, TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, terms, tfs, ends = [], [], [], [0]
                for raw in _raw(part.column("text")):
                    own = terms_of(raw)
                    known = [t for t in map(get, own) if t is not None]
                    which, times = np.unique(np.array(known, np.int32), return_counts=True)
                    sizes.append(len(own))
                    terms.append(which)
                    tfs.append(times.astype(np.int32))
                    ends.append(ends[-1] + len(which))
                ends = pa.array(ends, pa.int32())
                listed = lambda parts: pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))
                rows = pa.array(number + np.arange(part.num_rows))
                number += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [rows, part.column("doc_id"), pa.array(sizes, pa.int64()), listed(terms), listed(tfs)],
                    ["row", "doc_id", "n", "terms", "tfs"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, DOCUMENT)


INDEX = "m long, piece int, doc_ids array<long>, rows array<long>, terms binary, tfs binary, counts binary, places binary"


def _ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i4")


def build_index(documents: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """INDEX rows, a row for each piece of a stratum.

    documents: DOCUMENT rows with their m. A row's posting groups are (term, tf, count), sorted by
    term and tf, and `places` lists the documents of all groups, one group after the other.
    """
    sizes = documents.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / piece_rows).cast("int").alias("__pieces"))
    cut = documents.join(sizes, "m").withColumn("piece", F.pmod(F.xxhash64("row"), F.col("__pieces")).cast("int"))
    names = ["m", "piece", "row", "doc_id", "terms", "tfs"]

    def pack(rows: pa.Table) -> list:
        flat = lambda c: rows.column(c).combine_chunks().flatten().to_numpy().astype(np.int32)
        terms, tfs = flat("terms"), flat("tfs")
        lengths = pc.list_value_length(rows.column("terms")).to_numpy()
        place = np.repeat(np.arange(rows.num_rows, dtype=np.int32), lengths)
        order = np.lexsort((place, tfs, terms))
        terms, tfs, place = terms[order], tfs[order], place[order]
        new = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])]) if len(terms) else np.zeros(0, int)
        counts = np.diff(np.r_[new, len(terms)])
        binary = lambda a: a.astype("<i4").tobytes()
        return [
            rows.column("m")[0].as_py(), rows.column("piece")[0].as_py(), rows.column("doc_id").to_pylist(),
            rows.column("row").to_pylist(), binary(terms[new]), binary(tfs[new]), binary(counts), binary(place),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("m", pa.int64()), ("piece", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64()))]
            + [(c, pa.binary()) for c in ("terms", "tfs", "counts", "places")]
        )
        out = lambda packed: pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(packed, schema)], schema=schema)
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            m, piece = table.column("m").to_numpy(), table.column("piece").to_numpy()
            edges = np.flatnonzero((m[1:] != m[:-1]) | (piece[1:] != piece[:-1])) + 1
            for a, b in zip(np.r_[0, edges[:-1]] if len(edges) else [], edges):
                yield out(pack(table.slice(a, b - a)))
            held = table.slice(edges[-1]) if len(edges) else table
        if held is not None and held.num_rows:
            yield out(pack(held))

    dealt = cut.select(*names).repartition("m", "piece").sortWithinPartitions("m", "piece", "doc_id", "row")
    return dealt.mapInArrow(run, INDEX)


class _Queries:
    """Asked terms of some items as arrays by term: entries of a term are start[t] to start[t + 1]."""

    def __init__(self, entries: list[tuple[int, int, int]], n_terms: int, n_items: int):
        table = np.array(entries, np.int64).reshape(-1, 3)  # (term, item, weight x times)
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        self.item, self.worth = table[:, 1].copy(), table[:, 2].copy()
        self.start = np.searchsorted(table[:, 0], np.arange(n_terms + 1))
        self.n_items = n_items


def _search_piece(queries: _Queries, piece: dict, floors: np.ndarray, k: int):
    """(item, doc_id, row, score) of a piece's k best documents for each item that can reach its floor."""
    terms, tfs, counts, places = (_ints(piece[c]).astype(np.int64) for c in ("terms", "tfs", "counts", "places"))
    n, m = len(piece["rows"]), piece["m"]
    each_tf = np.unique(tfs)
    impact = impacts(each_tf, m)[np.searchsorted(each_tf, tfs)]  # of a posting group
    begin, end = queries.start[terms], queries.start[terms + 1]
    # Groups of a term stand by ascending tf, so its last group holds the largest impact.
    last = np.flatnonzero(np.r_[terms[1:] != terms[:-1], True]) if len(terms) else np.zeros(0, int)
    bound = np.zeros(queries.n_items, np.int64)
    sizes = (end - begin)[last]
    at = np.repeat(begin[last] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    np.add.at(bound, queries.item[at], queries.worth[at] * np.repeat(impact[last], sizes))
    wanted = (bound > 0) & (bound >= floors)
    if not wanted.any():
        return None
    column = np.cumsum(wanted) - 1
    chosen = np.flatnonzero(wanted)
    scores = np.zeros((n, len(chosen)), np.int64)
    flat = scores.reshape(-1)
    first = np.cumsum(counts) - counts
    work = np.cumsum(counts * (end - begin))
    at = 0
    while at < len(terms):  # some groups at a time
        done = work[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(work, done + PAIRS_AT_ONCE, "right")))
        g = np.repeat(np.arange(at, to), (end - begin)[at:to])
        e = begin[g] + np.arange(len(g)) - np.repeat(np.r_[0, np.cumsum((end - begin)[at:to])[:-1]], (end - begin)[at:to])
        use = wanted[queries.item[e]]
        g, e = g[use], e[use]
        spread = counts[g]
        doc = places[np.repeat(first[g] - (np.cumsum(spread) - spread), spread) + np.arange(spread.sum())]
        np.add.at(flat, doc * len(chosen) + np.repeat(column[queries.item[e]], spread), np.repeat(queries.worth[e] * impact[g], spread))
        at = to
    out = []
    for c, item in enumerate(chosen):
        mine = scores[:, c]
        good = np.flatnonzero((mine > 0) & (mine >= floors[item]))
        if len(good) > k:  # documents stand by doc_id, so a stable order keeps the smaller ids
            good = good[np.argsort(-mine[good], kind="stable")[:k]]
        out.append((np.full(len(good), item), good, mine[good]))
    item, doc, score = (np.concatenate(p) for p in zip(*out))
    return item, doc, score


HITS = "item int, doc_id long, row long, score long"


def _search(index: DataFrame, queries: _Queries, floors: np.ndarray, k: int) -> DataFrame:
    """HITS of every piece, those of an item at least at its floor; floors rise within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor, best = floors.copy(), np.zeros((queries.n_items, k), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                piece = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                found = _search_piece(queries, piece, floor, k)
                if found is None:
                    continue
                item, doc, score = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item.astype(np.int32)), pa.array(piece["doc_ids"], pa.int64()).take(pa.array(doc)),
                     pa.array(piece["rows"], pa.int64()).take(pa.array(doc)), pa.array(score)],
                    ["item", "doc_id", "row", "score"],
                )
                order = np.lexsort((-score, item))
                item, score = item[order], score[order]
                merged = np.zeros((queries.n_items, 2 * k), np.int64)
                merged[:, :k] = best
                merged[item, k + np.arange(len(item)) - np.searchsorted(item, item)] = score
                best = -np.sort(-merged, axis=1)[:, :k]
                floor = np.maximum(floor, best[:, k - 1])

    return index.mapInArrow(run, HITS)


def _bounds(index: DataFrame, queries: _Queries) -> DataFrame:
    """(m, item, bound): what a document of a stratum scores for an item at most, where that is above 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m, t, f in zip(*(batch.column(c).to_pylist() for c in ("m", "terms", "tfs"))):
                terms, tfs = _ints(t), _ints(f)
                last = np.flatnonzero(np.r_[terms[1:] != terms[:-1], True]) if len(terms) else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(last), m, np.int64)), pa.array(terms[last]), pa.array(tfs[last])], ["m", "term", "tf"]
                )

    largest = index.select("m", "terms", "tfs").mapInArrow(run, "m long, term int, tf int")
    largest = largest.groupBy("m", "term").agg(F.max("tf").cast("long").alias("tf"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, term, tf = (batch.column(c).to_numpy() for c in ("m", "term", "tf"))
            impact = impacts(tf, m)
            size = queries.start[term + 1] - queries.start[term]
            at = np.repeat(queries.start[term] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(m, size)), pa.array(queries.item[at].astype(np.int32)), pa.array(queries.worth[at] * np.repeat(impact, size))],
                ["m", "item", "bound"],
            )

    return largest.mapInArrow(add, "m long, item int, bound long").groupBy("m", "item").agg(F.sum("bound").alias("bound"))


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _some_items(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k best documents of the items of `asked`, at most about ASKED_AT_ONCE rows."""
    spark = docs.sparkSession
    entries = asked.collect()  # bounded by the passes
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in entries}))}
    ids = sorted({r["item_id"] for r in entries}, key=lambda v: (v is None, v or 0))
    number = {v: i for i, v in enumerate(ids)}
    rows = stored(_documents(docs, vocabulary), "term-counts")
    n, total = rows.agg(F.sum((F.col("n") > 0).cast("long")), F.sum("n")).first()
    n, total = n or 0, total or 0
    held = rows.where(F.size("terms") > 0)
    df = {r["term"]: r["count"] for r in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    worth = [
        (vocabulary[t], number[r["item_id"]], r["times"] * weight(n, df[vocabulary[t]]))
        for r in entries
        if vocabulary[t := bytes(r["term"])] in df
    ]
    queries = _Queries(worth, len(vocabulary), len(ids))
    placed = held.withColumn("m", normaliser(n, total))
    index = stored(build_index(placed), "lexical-index")
    bounds = stored(_bounds(index, queries), "stratum-bounds")
    # First the stratum with each item's best bound, then those that can still reach its floor.
    openers = bounds.groupBy("item").agg(F.max(F.struct("bound", "m")).alias("b")).select(F.col("b.m").alias("m")).distinct()
    opening = stored(_search(index.join(openers, "m", "left_semi"), queries, np.zeros(len(ids), np.int64), k), "opening-hits")
    floors = np.zeros(len(ids), np.int64)
    for r in _ranked(opening, k).where(F.col("rank") == k).collect():  # a row an item
        floors[r["item"]] = r["score"]
    told = spark.createDataFrame([(i, int(f)) for i, f in enumerate(floors)], "item int, floor long")
    open_still = bounds.join(F.broadcast(told), "item").where("bound >= floor").groupBy("m").agg(F.max("bound").alias("best"))
    rest = index.join(open_still, "m").join(openers, "m", "left_anti")
    rest = rest.sortWithinPartitions(F.desc("best"), "m", "piece").select(*[f.split()[0] for f in INDEX.split(", ")])
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
    hits = stored(opening.union(_search(rest, queries, floors, k)), "hits")
    return _ranked(hits, k).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = K, at_once: int = ASKED_AT_ONCE) -> DataFrame:
    """The k highest-scoring documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score.

    Only scores above 0 count; equal scores go to the smaller doc_id, a null one last, then to rows
    as they are read. Every row of docs is a document of its own, repeated rows too; texts that are
    null or without a term are in no result. Rows that share an item_id (null too) are one query,
    equal rows counting once; an item without a term has no rows. Texts are taken whole. Other
    columns are ignored; an empty table gives an empty result.
    """
    asked = stored(asked_terms(items), "asked-terms")
    passes = max(1, -(-asked.count() // at_once))
    out = None
    for i in range(passes):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i)
        found = _some_items(docs, mine, k)
        out = found if out is None else out.union(found)
    return out
