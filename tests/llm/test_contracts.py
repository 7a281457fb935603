"""The queries on the small tables, held against plain Python and SQL."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import __spark_entry__ as contract
from gridmotion.llm import queries
from oracle import compare, connect


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf_dir, name):
    assert not compare(spark, connect(sf_dir), name, sf_dir)


def test_op1(spark, sf_dir, docs):
    rows = queries.op1_sharding(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    shards, homes = {}, {}
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "bytes")
        shards.setdefault(r["shard"], []).append((r["slot"], r["size"]))
        homes.setdefault(raw, set()).add(r["shard"])
    assert set(shards) == set(range(8)) and all(len(h) == 1 for h in homes.values())
    for slots in shards.values():
        assert sorted(s for s, _ in slots) == list(range(len(slots)))
    loads = [sum(n for _, n in slots) for slots in shards.values()]
    assert max(loads) - sum(loads) / 8 <= max(len(t.encode()) + 1 for t in docs.values()) * 2


def simhash_of(text: str) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op2(spark, sf_dir, docs):
    rows = queries.op2_simhash(spark, sf_dir).collect()
    prints = {d: simhash_of(t) for d, t in docs.items()}
    label = {d: d for d in docs}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == [
        (d, f"{prints[d]:016x}", root(d)) for d in ids
    ]


def test_op4(spark, sf_dir, docs):
    rows = queries.op4_lm(spark, sf_dir).collect()
    tokens = {d: [*t.encode().lower().split(), b""] for d, t in docs.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    counts = Counter(w for d in docs if not held[d] for w in tokens[d])
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(docs)
    gain = 0.0
    for r in rows:
        own = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(own), total)
        assert r["n_known"] == sum(w in counts for w in own)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0
        gain += (r["score"] - r["base_score"]) * r["held_out"]
    assert gain > 0  # the latent states say more about unseen texts than word counts do


def ids_of(vocabulary, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    return {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t in docs.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op8(spark, sf_dir, docs, vocabulary):
    rows = queries.op8_packing(spark, sf_dir).collect()
    ids, pieces, sequences = ids_of(vocabulary, docs), {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and crc(part) == r["ids_crc32"]
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, own in pieces.items():
        own.sort()
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert sum(n for _, _, n in own) == len(ids[d]) and all(n == 2048 for _, _, n in own[1:])
    assert set(pieces) == set(docs)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= math.ceil(sum(map(len, ids.values())) / 2048) * 1.02 + 1


def test_op10(spark, sf_dir, docs, vocabulary):
    rows = {r["doc_id"]: r for r in queries.op10_tokens(spark, sf_dir).collect()}
    ids, before = ids_of(vocabulary, docs), 0
    for d in sorted(docs):
        r = rows[d]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (before, len(ids[d]), crc(ids[d]))
        before += len(ids[d])
    assert len(rows) == len(docs)


def test_op5_grades_labelled_documents(spark, sf_dir):
    rows = queries.op5_quality(spark, sf_dir).collect()
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    graded = {r["doc_id"]: r for r in rows if r["doc_id"] in labels}
    right = sum(r["kept"] == (labels[d]["quality"] == 1 and labels[d]["toxic"] == 0) for d, r in graded.items())
    assert right >= 0.9 * len(graded)
    assert all(0 <= r["tail"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in rows)


def test_all_are_registered():
    names = set(contract.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {n[: n.index("_") + 1] for n in names if n.startswith("op")}
    assert "pipeline" in names
