"""Near-duplicate documents by SimHash fingerprints and a covering code.

Fingerprints are points of {0,1}^64. The anchors are the words of a code that covers this
space: the direct sum of two Golay codes (23 bits, covering radius 3), a Hamming code (15 bits,
radius 1) and a repetition code (3 bits, radius 1). All four are perfect, so the anchor of any
point is found by a syndrome table. Two fingerprints that differ in at most t bits have a point
between them within t/2 of both; the anchor of that point lies within the covering radius
plus t/2 of either, so the two of them span the covering radius plus the whole threshold. Each
fingerprint is replicated to the anchors of all points within t/2 of it (about 17 for t = 2),
and only fingerprints that meet at an anchor are compared. Equal fingerprints are collapsed
first, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmotion.llm.common import slices, stored
from gridmotion.llm.components import connected

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
CROWD = 2048  # fingerprints compared in place at one anchor; beyond, midpoints settle them
SMALL = 32


def fingerprint(raw: bytes, size: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text: a bit is set if it is in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()  # bytes: only A-Z and the six ASCII separators
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def text_mark(text: Column) -> Column:
    """Tells rows with the same doc_id, or with none, apart by their text; never null."""
    return F.coalesce(F.md5(text), F.lit("null"))


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint as a signed long, digest of the text) of every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                prints = np.array([fingerprint(t or b"", size) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(prints.view(np.int64)), part.column("mark")], ["doc_id", "fp", "mark"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("mark", text_mark(F.col("text"))).mapInArrow(run, "doc_id long, fp long, mark string")


class CoveringCode:
    """Direct sum of perfect codes over the 64 bits; gives the anchor of any point."""

    # The Golay generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1.
    GOLAY = 0b110001110101

    def __init__(self):
        golay, remainder = [], 1
        for _ in range(23):
            golay.append(remainder)
            remainder <<= 1
            if remainder >> 11:
                remainder ^= self.GOLAY
        blocks = [(golay, 3), (golay, 3), (list(range(1, 16)), 1), ([1, 2, 3], 1)]
        self.blocks, at = [], 0
        for columns, radius in blocks:
            # The lightest error of each syndrome; in a perfect code there is exactly one.
            leaders = np.zeros(1 << max(columns).bit_length(), np.uint64)
            for weight in range(1, radius + 1):
                for bits in combinations(range(len(columns)), weight):
                    syndrome = 0
                    for b in bits:
                        syndrome ^= columns[b]
                    leaders[syndrome] = sum(1 << (at + b) for b in bits)
            self.blocks.append((at, np.array(columns, np.int64), leaders))
            at += len(columns)

    def syndromes(self, points: np.ndarray) -> list[np.ndarray]:
        out = []
        for at, columns, _ in self.blocks:
            syndrome = np.zeros(len(points), np.int64)
            for i, column in enumerate(columns):
                syndrome ^= ((points >> np.uint64(at + i)) & np.uint64(1)).astype(np.int64) * column
            out.append(syndrome)
        return out

    def around(self, points: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(points moved by a mask, their anchors) for all masks of at most `radius` bits."""
        own = self.syndromes(points)
        for weight in range(radius + 1):
            for bits in combinations(range(64), weight):
                mask = np.array([sum(1 << b for b in bits)], np.uint64)
                moved = points ^ mask
                anchor = moved.copy()
                for syndrome, shift, (_, _, leaders) in zip(own, self.syndromes(mask), self.blocks):
                    anchor ^= leaders[syndrome ^ shift]
                yield moved, anchor


def _replicas(prints: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = CoveringCode()
        for batch in batches:
            points = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            anchors = np.stack([a for _, a in code.around(points, radius)], axis=1)
            anchors.sort(axis=1)
            first = np.ones(anchors.shape, bool)
            first[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
            row, _ = np.nonzero(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors[first].view(np.int64)), pa.array(points[row].view(np.int64))],
                ["anchor", "fp"],
            )

    return prints.select("fp").mapInArrow(run, "anchor long, fp long")


def _forest(points: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect what is within `most` bits, no more than points less one."""
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= most
    left, links = np.ones(len(points), bool), []
    while left.any():
        first = int(np.argmax(left))
        left[first], front = False, [first]
        while front:
            at = front.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            links += [(at, int(i)) for i in new]
            front += new.tolist()
    return links


def _compared(replicas: DataFrame, most: int) -> DataFrame:
    """Links (a, b) at each anchor; crowded anchors give (midpoint, fp) rows instead."""

    def links_of(anchor, points, code, begun):
        same = lambda k: anchor[k:] == anchor[:-k]
        edge = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        size = np.diff(np.r_[edge, len(anchor)])
        large = (size > SMALL) | (anchor[edge] == begun if begun is not None else False)
        small = np.repeat(~large, size)
        a, b, k = [], [], 1
        while k < min(SMALL, len(anchor)):
            pair = np.flatnonzero(same(k) & small[k:])
            if not len(pair):
                break
            near = pair[np.bitwise_count(points[pair] ^ points[pair + k]) <= most]
            a.append(points[near])
            b.append(points[near + k])
            k += 1
        middle, crowd = [], []
        for start, n in zip(edge[large].tolist(), size[large].tolist()):
            here = points[start : start + n]
            if n <= CROWD and anchor[start] != begun:
                found = np.array(_forest(here, most), np.int64).reshape(-1, 2)
                a.append(here[found[:, 0]])
                b.append(here[found[:, 1]])
            else:
                for moved, at in code.around(here, most // 2):
                    mine = at == anchor[start]
                    middle.append(moved[mine])
                    crowd.append(here[mine])
        join = lambda parts: np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
        a, b, middle, crowd = map(join, (a, b, middle, crowd))
        kind = np.r_[np.zeros(len(a), bool), np.ones(len(middle), bool)]
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(np.r_[a, middle]), pa.array(np.r_[b, crowd])], ["crowded", "a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, begun = CoveringCode(), None
        anchor, points = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for batch in batches:
            more = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("anchor", "fp")]
            anchor, points = np.r_[anchor, more[0]], np.r_[points, more[1]]
            if not len(anchor):
                continue
            # The last anchor may go on in the next batch. A very crowded one goes out in parts:
            # its fingerprints meet at their midpoints, wherever these were made.
            other = np.flatnonzero(anchor != anchor[-1])
            keep = int(other[-1]) + 1 if len(other) else 0
            if keep:
                yield links_of(anchor[:keep], points[:keep], code, begun)
                anchor, points = anchor[keep:], points[keep:]
            if len(anchor) > CROWD:
                begun = anchor[0]
                yield links_of(anchor, points, code, begun)
                anchor, points = anchor[:0], points[:0]
        if len(anchor):
            yield links_of(anchor, points, code, begun)

    sorted_ = replicas.repartition("anchor").sortWithinPartitions("anchor", "fp")
    return sorted_.mapInArrow(run, "crowded boolean, a long, b long")


def _components(docs: DataFrame, size: int, most: int) -> DataFrame:
    """(doc_id, mark, fp, label, component_id) of every row; the label tells components apart."""
    rows = stored(fingerprints(docs, size), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    met = stored(_compared(_replicas(prints, most // 2), most), "links")
    stars = met.where("crowded").groupBy("a").agg(F.min("b").alias("hub"))
    crowded = met.where("crowded").join(stars, "a").where("b <> hub").select(F.col("b").alias("a"), F.col("hub").alias("b"))
    labels = connected(met.where("NOT crowded").select("a", "b").union(crowded))
    named = prints.join(labels, prints["fp"] == labels["node"], "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    named = stored(named, "classes")
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "label").select("fp", "label", "component_id")
    return rows.join(classes, "fp")


def first_of_each(docs: DataFrame, size: int = SHINGLE_WORDS, most: int = MAX_BITS) -> DataFrame:
    """(doc_id, mark) of one row of each component: the smallest doc_id, null last, then mark."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    return _components(docs, size, most).groupBy("label").agg(F.min(key).alias("key")).select("key.doc_id", "key.mark")


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, most: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of docs (doc_id, text).

    `most` is even. A null or empty text has fingerprint zero and is linked like any other; a
    null doc_id gets a row too, and the component's id is the smallest doc_id that is not null
    (null if there is none); repeated rows stay repeated; other columns are ignored and an
    empty table gives an empty result.
    """
    if most % 2 or most < 0:
        raise ValueError("the threshold must be an even number of bits")
    return _components(docs, size, most).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
