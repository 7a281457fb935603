"""Packing pieces of documents into sequences of fixed length.

The number of pieces of each length (at most `capacity` numbers) is all the planner sees. A
configuration says how many pieces of each length share a sequence. The linear program "fewest
sequences that cover the histogram" is solved by multiplicative weights: lengths that are
covered less get more weight, an unbounded-knapsack table prices the best configuration under
these weights, and that one is taken for a step. The fractional counts are rounded down, and
best fit, run on the histogram, places what is left. The pieces then take their places by
their rank within their length, in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.llm.common import Encoder, slices, stored

CAPACITY = 2048
ROUNDS = 400  # pricings of one program; what is uncovered then enters another one
A_ROUND = 256  # lengths a pricing takes configurations for, the heaviest first
STEP = 0.25  # share of a length's uncovered pieces that one step may cover
POWER = 1.1  # of the length in its weight; above 1, short pieces are spared for later rooms
LAG = 0.3  # how fast a length loses weight as it is covered
NEAR = 0.3  # share of the best price a configuration may fall short
FULL = 0.9995  # share of a sequence a configuration fills at least: one free place of 2,048
END_ID = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = total % capacity or min(total, capacity)
    starts = [0, *range(first, total, capacity)]
    return [(a, (starts[i + 1] if i + 1 < len(starts) else total) - a) for i, a in enumerate(starts)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Encode whole texts, add the end id and cut the ids of long ones.

    A null text is empty and gives one piece of one id; a null doc_id and repeated rows are
    pieces like any other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for key, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text"))):
                    raw = np.append(ids, np.uint32(END_ID)).astype("<u4").tobytes()
                    for i, (start, n) in enumerate(cut(len(raw) // 4, capacity)):
                        rows.append((key, i, start, n, zlib.crc32(raw[4 * start : 4 * (start + n)])))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


Group = tuple[int, list[tuple[int, int]]]  # sequences of one pattern: [(length, pieces of it)]


def priced(weights: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The most weight that fits each room: an unbounded knapsack by dynamic programming."""
    best = np.zeros(capacity + 1)
    for room in range(int(lengths[0]), capacity + 1):
        fits = np.searchsorted(lengths, room, "right")
        best[room] = (weights[:fits] + best[room - lengths[:fits]]).max()
    return best


def configuration(
    first: int, weights: np.ndarray, lengths: np.ndarray, best: np.ndarray, spare: np.ndarray, capacity: int
) -> dict[int, int]:
    """Places in `lengths` and their pieces: one of `first`, the room filled by the prices, ties to the longer.

    No length is taken more often than it has spare pieces.
    """
    taken, room, at = np.zeros(len(lengths), np.int64), capacity, first
    while at is not None:
        taken[at] += 1
        room -= int(lengths[at])
        fits = int(np.searchsorted(lengths, room, "right"))
        value = np.where(spare[:fits] >= taken[:fits] + 1, weights[:fits] + best[room - lengths[:fits]], 0.0)
        at = fits - 1 - int(np.argmax(value[::-1])) if fits and value.max() > 0 else None
    return {int(i): int(taken[i]) for i in np.flatnonzero(taken)}


def fractional(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[float, dict[int, int]]]:
    """Configurations and their fractional counts, by multiplicative weights.

    A round prices the weights once and takes a configuration for each of the heaviest lengths, as
    long as they come near the best price; a step covers a share of a length's pieces, one sequence
    at least. It goes on until no configuration of what is uncovered fills a sequence (`FULL`).
    """
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[n] for n in lengths.tolist()], float)
    covered, out = np.zeros(len(lengths)), {}
    for _ in range(rounds):
        spare = demand * (1 - covered)
        open_ = spare >= 1
        if not open_.any():
            break
        # A piece weighs more than the room it takes the longer it is, and while its length lags behind.
        weights = np.where(open_, lengths**POWER * np.exp(-LAG * covered), 0.0)
        best = priced(weights, lengths, capacity)
        within = np.where(open_, spare, 0.0)  # what this round may still take of each length
        took = False
        for first in np.argsort(-weights, kind="stable")[:A_ROUND].tolist():
            if within[first] < 1:
                continue
            found = configuration(first, weights, lengths, best, within, capacity)
            places, pieces_ = np.array(list(found)), np.array(list(found.values()))
            if lengths[places] @ pieces_ < FULL * capacity or weights[places] @ pieces_ < (1 - NEAR) * best[capacity]:
                continue
            step = max(1.0, STEP * float((spare[places] / pieces_).min()))
            step = min(step, float((within[places] / pieces_).min()))
            covered[places] += step * pieces_ / demand[places]
            within[places] -= step * pieces_
            key = tuple(sorted(zip(lengths[places].tolist(), pieces_.tolist())))
            out[key] = out.get(key, 0.0) + step
            took = True
        if not took:
            break
    return [(count, dict(key)) for key, count in out.items()]


def best_fit(histogram: dict[int, int], capacity: int, opened: list[Group] = ()) -> list[Group]:
    """Best-fit decreasing on the histogram; sequences of one pattern move together.

    A piece goes to the fullest sequence it fits in. All pieces of a length are placed at once,
    as many to a sequence as one after the other would be.
    """
    by_room: dict[int, list[Group]] = {}
    rooms = np.zeros(capacity + 1, bool)

    def put(room: int, count: int, pattern: list[tuple[int, int]]) -> None:
        if count:
            by_room.setdefault(room, []).append((count, pattern))
            rooms[room] = True

    for count, pattern in opened:
        put(capacity - sum(n * k for n, k in pattern), count, list(pattern))
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            fit = length + int(np.argmax(rooms[length:])) if rooms[length:].any() else capacity
            if not rooms[fit]:
                by_room.setdefault(capacity, []).append((left, []))
                rooms[capacity] = True
            count, pattern = by_room[fit].pop()
            rooms[fit] = bool(by_room[fit])
            each = fit // length
            full = min(count, left // each)
            put(fit - each * length, full, [*pattern, (length, each)])
            left -= full * each
            if full < count:
                rest = count - full
                if 0 < left < each:
                    put(fit - left * length, 1, [*pattern, (length, left)])
                    left, rest = 0, rest - 1
                if rest and pattern:
                    put(fit, rest, pattern)
    return [(count, pattern) for groups in by_room.values() for count, pattern in groups if pattern]


def by_program(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[list[Group], dict[int, int]]:
    """(sequences of the rounded program, what it leaves); what rounding frees enters the program again."""
    left, rounded = dict(histogram), []
    while left:
        before = len(rounded)
        for count, found in sorted(fractional(left, capacity, rounds), key=lambda x: -x[0]):
            n = min(int(count + 1e-6), *(left[length] // k for length, k in found.items()))
            if n:
                rounded.append((n, sorted(found.items(), reverse=True)))
                for length, k in found.items():
                    left[length] -= n * k
        left = {n: c for n, c in left.items() if c}
        if len(rounded) == before:
            break
    return rounded, left


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[Group]:
    """Sequences for a histogram of lengths: the rounded program, what fills no sequence by best fit."""
    histogram = {n: c for n, c in histogram.items() if c}
    whole: list[Group] = [(c, [(n, 1)]) for n, c in histogram.items() if n == capacity]
    rounded, left = by_program({n: c for n, c in histogram.items() if n < capacity}, capacity, rounds)
    return whole + best_fit(left, capacity, rounded)


def intervals(groups: list[Group]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, pieces a sequence, offset of the first)."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for count, pattern in groups:
        offset = 0
        for length, k in pattern:
            out.setdefault(length, []).append((ranks.get(length, 0), first, k, offset))
            ranks[length] = ranks.get(length, 0) + count * k
            offset += k * length
        first += count
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def ranked(rows: DataFrame, group: str, order: list[str], rank: str, each: int = 50_000) -> DataFrame:
    """Number rows 0.. within their group, a group of any size being dealt over many tasks.

    Rows are salted by a hash, numbered within (group, salt), and moved on by what the salts
    before hold; the table of those is no larger than groups times salts.
    """
    total = rows.count()
    salts = max(1, -(-total // each))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    inside = Window.partitionBy(group, "__salt").orderBy(*order)
    numbered = salted.withColumn("__n", F.row_number().over(inside) - 1)
    sizes = salted.groupBy(group, "__salt").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(group).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col(group).alias("__g"),
        F.col("__salt").alias("__s"),
        F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__base"),
    )
    joined = numbered.join(bases, (F.col(group) == F.col("__g")) & (F.col("__salt") == F.col("__s")))
    return joined.withColumn(rank, F.col("__n") + F.col("__base")).drop("__g", "__s", "__salt", "__n", "__base")


def pack(parts: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Give every piece (doc_id, piece, length, further columns) a sequence and an offset.

    Returns the pieces with sequence_id and offset; offsets are gapless from 0. Pieces of null
    doc_id and repeated pieces are placed like others; an empty table packs to nothing. A
    length outside 1 to capacity is refused.
    """
    counts = parts.groupBy("length").count().collect()  # at most `capacity` rows
    histogram = {r["length"]: r["count"] for r in counts}
    if any(n is None or not 1 <= n <= capacity for n in histogram):
        raise ValueError("a piece's length must lie between 1 and the capacity")
    places = intervals(plan(histogram, capacity, rounds))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "__rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                mine = np.flatnonzero(length == n)
                rows = places[n]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                along = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 1] + along // row[:, 2]
                offset[mine] = row[:, 3] + along % row[:, 2] * n
            kept = [c for c in batch.schema.names if c != "__rank"]
            columns = [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    order = [c for c in ("doc_id", "piece", "ids_crc32") if c in parts.columns]
    numbered = ranked(parts, "length", order, "__rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return numbered.select(*parts.columns, "__rank").mapInArrow(
        place, f"{fields}, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Encode, cut and pack documents; the encoded pieces are stored once."""
    return pack(stored(pieces(docs, vocabulary, capacity), "pieces"), capacity, rounds)
