"""Token ids in shard files with a minimal perfect hash index for keyed access.

Documents are written in ascending key order. A task writes shards of bounded size: the raw
ids of its documents end to end as little-endian unsigned numbers, of 16 bits where the
vocabulary allows and of 32 bits otherwise, and an index beside them. The index is a minimal perfect hash over the shard's keys (levels of bit arrays: a key
alone at its place in a level is settled there, the others go on to the next level), and holds
at each slot a fingerprint of the key, the document's offset and its count of ids. A lookup
costs a few bit tests and one slot read, whatever the shard's size.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmotion.llm.common import Encoder, fresh_folder, open_store, slices, write_once

SHARD_IDS = 16_000_000  # a shard is closed beyond so many ids, 32 or 64 MB
END_ID = 0
SLOT = np.dtype([("fingerprint", "<u4"), ("offset", "<u8"), ("count", "<u8")])
KEY = np.dtype([("null", "u1"), ("key", "<i8"), ("copy", "<u4")])
MAGIC = b"IDX1"


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A bijective 64-bit mixing of whole numbers (the splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 1) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def key_hash(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of (null flag, key, number among equal keys)."""
    side = mix(keys["copy"].astype(np.uint64) * np.uint64(2) + keys["null"], seed + 1)
    return mix(keys["key"].view(np.uint64) ^ side, seed)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit hashes."""

    SPREAD = 2  # places a level has for each key that reaches it

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # one boolean array a level, held as packed 64-bit words
        self.ranks, settled = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(settled + np.cumsum(ones) - ones)
            settled += int(ones.sum())

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels, left = [], hashes
        while len(left):
            size = (len(left) * cls.SPREAD + 63) // 64 * 64
            place = (mix(left, len(levels) + 101) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[place]]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash; -1 where no level settles it (certainly not a key)."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            place = mix(hashes[open_], level + 101) % np.uint64(len(bits) * 64)
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            here = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word[here]] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            out[open_[here]] = ranks[word[here]] + np.bitwise_count(below)
            open_ = open_[~here]
        return out


def encode_index(keys: np.ndarray, offsets: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """Index file: header, bit arrays of the levels, slots, then the keys in payload order."""
    seed = 1
    while len(np.unique(key_hash(keys, seed))) < len(keys):
        seed += 1
    hashes = key_hash(keys, seed)
    perfect = PerfectHash.build(hashes)
    table = np.zeros(len(keys), SLOT)
    at = perfect.slots(hashes)
    table["fingerprint"][at] = mix(hashes, 7) & np.uint64(0xFFFFFFFF)
    table["offset"][at], table["count"][at] = offsets, counts
    levels = [len(bits) for bits in perfect.levels]
    head = json.dumps({"seed": seed, "keys": len(keys), "width": width, "levels": levels}).encode()
    parts = [MAGIC, struct.pack("<I", len(head)), head, *(bits.tobytes() for bits in perfect.levels)]
    return b"".join([*parts, table.tobytes(), keys.tobytes()])


class ShardIndex:
    """An index file read back; finds documents by key."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not an index file")
        (size,) = struct.unpack_from("<I", raw, 4)
        head, at = json.loads(raw[8 : 8 + size]), 8 + size
        levels = []
        for n in head["levels"]:
            levels.append(np.frombuffer(raw, "<u8", n, at))
            at += 8 * n
        self.seed, self.width, self.perfect = head["seed"], head["width"], PerfectHash(levels)
        self.table = np.frombuffer(raw, SLOT, head["keys"], at)
        self.keys = np.frombuffer(raw, KEY, head["keys"], at + self.table.nbytes)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, offset, count) of keys; a stored fingerprint turns strangers away."""
        hashes = key_hash(keys, self.seed)
        slot = self.perfect.slots(hashes)
        here = slot >= 0
        row = self.table[np.where(here, slot, 0)] if len(self.table) else np.zeros(len(keys), SLOT)
        here &= row["fingerprint"] == (mix(hashes, 7) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return here, row["offset"].astype(np.int64), row["count"].astype(np.int64)

    def ids(self, payload, offset: int, count: int) -> np.ndarray:
        """A document's ids as unsigned 32-bit numbers, from the open payload file."""
        raw = payload.read_at(self.width * count, self.width * offset)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


class _Shard:
    """One payload file being written, and what its index needs."""

    def __init__(self, uri: str, stem: str, width: int):
        self.uri, self.stem, self.width = uri, stem, width
        self.path, self.out = write_once(uri, stem, ".ids")
        self.keys: list[tuple[int, int, int]] = []
        self.counts: list[int] = []
        self.ids = 0

    def add(self, key, ids: np.ndarray) -> None:
        copy = 0
        if self.keys and self.keys[-1][:2] == ((1, 0) if key is None else (0, key)):
            copy = self.keys[-1][2] + 1
        self.keys.append((1, 0, copy) if key is None else (0, key, copy))
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.counts.append(len(ids))
        self.ids += len(ids)

    def close(self) -> tuple[str, str, int, int]:
        self.out.close()
        counts = np.array(self.counts, np.int64)
        index, out = write_once(self.uri, self.stem, ".index")
        with out:
            out.write(encode_index(np.array(self.keys, KEY), np.cumsum(counts) - counts, counts, self.width))
        return self.path, index, len(counts), self.ids


MANIFEST = "partition int, number int, payload string, index string, documents long, ids long"


def write_shards(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Encode whole texts and write them in ascending key order; returns the manifest.

    One row a shard: its place in the order, its two files, its numbers of documents and ids.
    A null text is empty (the end id alone), a null key comes first, rows that share a key lie
    side by side in text order and each keeps its own entry, other columns are ignored, and an
    empty table gives an empty manifest. Every attempt of a task writes files of its own and
    only finished ones reach the manifest, so lost executors leave no half-written shard in it.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "token-shards")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, partition = Encoder(vocabulary), TaskContext.get().partitionId()
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        shard, rows = None, []
        for batch in batches:
            for part in slices(batch, "text"):
                for k, ids in zip(part.column("key").to_pylist(), encoder.encode(part.column("text"))):
                    if shard is None:
                        shard = _Shard(folder, f"{partition:06d}-{len(rows):04d}", width)
                    shard.add(k, np.append(ids, np.uint32(END_ID)))
                    if shard.ids >= shard_ids:
                        rows.append((partition, len(rows), *shard.close()))
                        shard = None
        if shard is not None:
            rows.append((partition, len(rows), *shard.close()))
        names = ["partition", "number", "payload", "index", "documents", "ids"]
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")
    ).withColumn("order", F.xxhash64("text"))
    ordered = rows.repartitionByRange("key", "order").sortWithinPartitions("key", "order", "text")
    path = fresh_folder(spark, "token-manifest")
    ordered.select("key", "text").mapInArrow(write, MANIFEST).write.parquet(path)
    return spark.read.schema(MANIFEST).parquet(path)


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the shards, found by key through the index and read from the payload.

    Returns doc_id, start (ids of all documents before it), n_tokens and ids_crc32.
    """
    spark = manifest.sparkSession
    # One row a shard, so the list stays small.
    shards = sorted(manifest.collect(), key=lambda r: (r["partition"], r["number"]))
    before, rows = 0, []
    for r in shards:
        rows.append((r["payload"], r["index"], before))
        before += r["ids"]
    listing = spark.createDataFrame(rows, "payload string, index string, before long")
    return listing.repartition(max(1, len(rows))).mapInArrow(
        _read_back, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            store, index_path = open_store(row["index"])
            with store.open_input_file(index_path) as f:
                index = ShardIndex(f.read())
            found, offset, count = index.find(index.keys)
            if not found.all():
                raise ValueError(f"{row['index']}: a key of the shard is not in its index")
            crc = np.zeros(len(found), np.int64)
            with store.open_input_file(open_store(row["payload"])[1]) as f:
                for i, (at, n) in enumerate(zip(offset.tolist(), count.tolist())):
                    crc[i] = zlib.crc32(index.ids(f, at, n).tobytes())
            keys = pa.array(index.keys["key"], pa.int64(), mask=index.keys["null"] == 1)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(offset + row["before"]), pa.array(count), pa.array(crc)],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def lookup(manifest_row, keys: list[int]) -> list[np.ndarray | None]:
    """Ids of single documents of one shard by key; None where the shard has no such key."""
    store, index_path = open_store(manifest_row["index"])
    with store.open_input_file(index_path) as f:
        index = ShardIndex(f.read())
    found, offset, count = index.find(np.array([(0, k, 0) for k in keys], KEY))
    out = []
    with store.open_input_file(open_store(manifest_row["payload"])[1]) as f:
        for here, at, n in zip(found, offset.tolist(), count.tolist()):
            out.append(index.ids(f, at, n) if here else None)
    return out


def token_table(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write shards, read them back."""
    return read_shards(write_shards(docs, vocabulary))
