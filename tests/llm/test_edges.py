"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, odd columns."""

import gzip
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridmotion.llm import (
    components,
    decontaminate,
    lm,
    packing,
    quality,
    sharding,
    simhash,
    substring,
    tokenized,
    topk,
    warc,
)
from gridmotion.llm.common import Encoder

CLASH = ["shard", "fp", "fingerprint", "label", "block", "key", "w", "row", "size", "kept"]
WORDS = [f"w{i}" for i in range(400)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


ODD = [None, "", "  \n\t ", "one", "Two Words", prose(300, 1), prose(300, 1), prose(30_000, 2), "ß Ünï " * 40, "\x1c x\x1fy"]


@pytest.fixture
def odd(documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id here"), (5, prose(300, 1)), (3, "same id, other text")]
    return documents(rows, CLASH)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


# ------------------------------------------------------------------ sharding


def brute_capacity(sizes, shards):
    def fits(capacity):
        used, load = 1, 0
        for n in sizes:
            if n > capacity:
                return False
            if load + n > capacity:
                used, load = used + 1, 0
            load += n
        return used <= shards

    return next(c for c in range(max(1, max(sizes)), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("few", [0, 3, 50_000])
def test_cuts_are_minimax(spark, few):
    rng = random.Random(few)
    for sizes in ([5], [3, 3, 3, 3], [rng.randint(1, 60) for _ in range(40)], [100, *[1] * 30]):
        ends = np.cumsum(sizes).tolist()
        frame = spark.createDataFrame(list(zip(sizes, ends)), "size long, end long").coalesce(2)
        cuts = sharding.minimax_cuts(frame, 4, few)
        loads = np.diff([0, *cuts])
        assert cuts[-1] == sum(sizes) and set(cuts) <= {0, *ends} and max(loads) == brute_capacity(sizes, 4)


def test_cuts_with_a_hot_group_are_not_searched_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(sharding, "bisect_right", None)
    sizes = [*[1] * 60, 100, *[1] * 60]
    frame = spark.createDataFrame(list(zip(sizes, np.cumsum(sizes).tolist())), "size long, end long").coalesce(2)
    cuts = sharding.minimax_cuts(frame, 4, few=10)
    assert cuts[-1] == sum(sizes) and max(np.diff([0, *cuts])) == brute_capacity(sizes, 4)


def test_sharding_odd_rows(odd, empty):
    rows = sharding.shard_documents(odd, shards=3, rows_each=2).collect()
    assert len(rows) == 13
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    null = [r for r in rows if r["doc_id"] == 0][0]
    assert (null["size"], null["text_crc32"]) == (1, None)
    assert sum(r["doc_id"] is None for r in rows) == 1
    assert sharding.shard_documents(empty).collect() == []


# ------------------------------------------------------------------ simhash


def test_code_is_perfect_and_anchors_cover():
    rng = np.random.default_rng(0)
    code = simhash.CoveringCode()
    points = rng.integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    own = {int(p): {int(a[i]) for _, a in code.around(points, 1)} for i, p in enumerate(points)}
    for p in points[:100]:
        (_, home), *_ = list(code.around(np.array([p]), 0))
        assert (int(home[0]) ^ int(p)).bit_count() <= 8  # the covering radius 3 + 3 + 1 + 1
        for _ in range(20):
            a, b = rng.choice(64, 2, replace=False)
            q = np.array([int(p) ^ (1 << int(a)) ^ (1 << int(b))], np.uint64)
            assert own[int(p)] & {int(x[0]) for _, x in code.around(q, 1)}
        assert all((x ^ int(p)).bit_count() <= 9 for x in own[int(p)])


@pytest.mark.parametrize("crowd,small", [(2048, 32), (4, 2), (1, 1)])
def test_links_of_fingerprints(spark, monkeypatch, crowd, small):
    """All routes (pairs, forests, midpoints) give the components of brute force."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(3)
    prints = set()
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(25):
            prints.add(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3])))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long").coalesce(2)
    met = simhash._compared(simhash._replicas(frame, 1), 2).collect()
    stars, links = {}, set()
    for r in met:
        if r["crowded"]:
            stars.setdefault(r["a"], []).append(r["b"])
        else:
            links.add((r["a"], r["b"]))
    links |= {(min(s), b) for s in stars.values() for b in s}
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    assert all(near(a, b) for a, b in links)

    def classes(pairs):
        root = {s: s for s in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return {s: find(s) for s in signed}

    assert classes(links) == classes([(a, b) for a in signed for b in signed if a < b and near(a, b)])


def test_simhash_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 13
    zero = {r["doc_id"]: r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert {0, 1, 2} <= set(zero) and set(zero.values()) == {0}
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert simhash.near_duplicates(empty).collect() == []
    with pytest.raises(ValueError):
        simhash.near_duplicates(empty, most=3)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (-5, 101)]
    found = {r["node"]: r["label"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in (-5, 100, 101)} == {-5}
    assert components.connected(spark.createDataFrame([], "a long, b long")).collect() == []


# ------------------------------------------------------------------ top k


def test_topk_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(200)]
    rows[3] = (3, None)
    rows[4] = (4, [1.0, None])
    rows[5] = (5, [float("nan")] * 8)
    rows[6] = (6, [float("inf")] * 8)
    rows[7] = (7, [3e38] * 8)
    rows[8] = (8, [0.5, -0.5])
    rows[9] = (9, [])
    rows += [(20, rows[20][1]), (20, rows[21][1]), (60, [5e6, -4e6] * 4), (60, [7e7, -3e9] * 4), (None, [1.0] * 8), (201, rows[40][1]), (202, rows[40][1])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = [tuple(r) for r in topk.top_k(frame).collect()]
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole.append((i, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    want = []
    for q in sorted({i for i, _ in whole if i % 20 == 0}):
        asked = [v for i, v in whole if i == q]  # rows of one id are one query
        score = lambda a, b: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
        scored = sorted((-score(a, v), i) for a in asked for i, v in whole if i != q)
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:20], 1)]
    assert sorted(got) == sorted(want) and any(i == 7 for _, _, i, _ in got)
    assert topk.top_k(frame.limit(0)).collect() == []


def test_topk_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "TILE", 16)
    rng = np.random.default_rng(2)
    v = (rng.normal(size=(400, 12)) * rng.gamma(2, 1, (400, 1))).round(2)
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    whole = np.floor(64 * v).astype(int)
    want = []
    for q in range(0, 400, 20):
        order = sorted((int(-s), i) for i, s in enumerate(whole @ whole[q]) if i != q)
        want += [(q, n, i, -s) for n, (s, i) in enumerate(order[:20], 1)]
    assert sorted(tuple(r) for r in topk.top_k(frame).collect()) == want


# ------------------------------------------------------------------ language model


def test_forward_is_exact_and_counts_add_up():
    rng = np.random.default_rng(0)
    model = lm.initial(rng.integers(0, 9, 6).astype(float), states=3)
    for n in (1, 2, 4):
        seq = rng.integers(0, 6, n)
        total = 0.0
        for path in np.ndindex(*[3] * n):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for t in range(1, n):
                p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
            total += p
        assert np.isclose(np.exp(lm.forward(model, [seq])[0]), total)
    seqs = [rng.integers(0, 6, n) for n in (5, 1, 9, 3)]
    counts = lm.expected(model, seqs)
    assert np.isclose(counts["emit"].sum(), 18) and np.isclose(counts["move"].sum(), 18 - 4)
    assert np.isclose(counts["start"].sum(), 4) and np.isclose(counts["log"][0], lm.forward(model, seqs).sum())
    # Each pass makes the sequences likelier (the smoothing is far smaller than the counts).
    seqs, log = [rng.integers(0, 3, 500) % (i % 2 + 2) for i in range(40)], []
    for _ in range(4):
        log.append(lm.forward(model, seqs).sum())
        model = lm.refit(model, lm.expected(model, seqs), np.ones(6))
    assert log == sorted(log)


def test_lm_odd_rows(odd, empty, documents):
    rows = lm.score_documents(odd, states=2, classes=16, passes=2).collect()
    assert len(rows) == 13 and all(np.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)} == {1}
    assert lm.score_documents(empty).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    lone = lm.score_documents(documents([(held, "never seen")]), states=2, classes=8).collect()
    assert [(r["held_out"], r["n_known"], r["train_tokens"]) for r in lone] == [(True, 0, 0)]


def test_lm_scores_whole_texts_a_few_at_a_time():
    lengths = np.random.default_rng(3).integers(1, 9, 400)
    lengths[[0, 17, 399]] = 500
    parts = list(lm.whole_texts(lengths, 64))
    assert [i for at, end in parts for i in range(at, end)] == list(range(400))
    assert all(lengths[at:end].sum() <= 64 or end == at + 1 for at, end in parts) and len(parts) < 80
    assert list(lm.whole_texts(lengths[:0], 64)) == []


# ------------------------------------------------------------------ quality


def test_quality_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), int(i % 3 == 1)) for i in range(8)] + [(1, None, None), (None, 1, 0), (5, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.graded_documents(odd, labels).collect()
    assert len(rows) == 13 and all(0 <= r["tail"] <= 1 for r in rows)
    assert quality.graded_documents(empty, labels).collect() == []
    assert len(quality.graded_documents(odd, labels.limit(0)).collect()) == 13


def test_ordinal_gradient():
    rng = np.random.default_rng(0)
    x, grade, cuts = rng.normal(size=30), rng.integers(0, 3, 30), np.array([-0.4, 0.7])
    loss, by_x, by_cut = quality._likelihood(x, grade, cuts)
    for i in range(5):
        step = np.eye(30)[i] * 1e-6
        assert np.isclose((quality._likelihood(x + step, grade, cuts)[0] - loss) / 1e-6, by_x[i], atol=1e-4)
    for j in range(2):
        step = np.eye(2)[j] * 1e-6
        assert np.isclose((quality._likelihood(x, grade, cuts + step)[0] - loss) / 1e-6, by_cut[j], atol=1e-4)


def test_quality_learns_and_bounds_its_sample(spark, documents):
    texts = [prose(60, i) + (" idiot" if i % 3 == 0 else "") + (" junk!!" * 9 if i % 3 == 1 else "") for i in range(900)]
    labels = spark.createDataFrame(
        [(i, int(i % 3 != 1), int(i % 3 == 0)) for i in range(900) if i % 5], "doc_id long, quality int, toxic int"
    )
    rows = quality.graded_documents(documents(texts), labels).where("doc_id % 5 = 0").collect()
    assert sum(r["kept"] == (r["doc_id"] % 3 == 2) for r in rows) >= 0.9 * len(rows)
    assert quality.training_rows(documents(texts), labels, bound=100).count() < 160


def test_quality_learns_from_all_labelled_documents(spark):
    docs = spark.range(41_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.range(42_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"), F.lit(0).alias("toxic"))
    rows = quality.training_rows(docs, labels)
    assert rows.count() == 41_000
    times = {r["id"]: (r["g0"], r["g1"], r["g2"]) for r in quality._times(rows).collect()}
    assert times[zlib.crc32(b"w:text")] == (0, 20_500, 20_500) and times[zlib.crc32(b"w:40999")] == (0, 0, 1)


# ------------------------------------------------------------------ archives


def test_archives_odd_rows(spark):
    big, other = "x" * 1000, "é" * 500  # both of 1000 bytes
    rows = [
        (1, "http://a/ b\n", big), (7, None, big), (7, "u", big), (3, "u", other), (None, "u", other), (None, "v", "y" * 2000),
        (None, "w", "y" * 2000), (4, "u", None), (5, "u", ""), (6, "u", "<p>\r\n\r\nbody"), (8, "u", "z" * 300_000), (9, "u", "s" * 999), (10, "u", "s" * 999),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, holder string")
    got = warc.read_archives(warc.write_archives(frame)).collect()
    assert len(got) == len(rows)
    kinds = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got if r["payload_bytes"] == 1000)
    assert kinds == [(0, 1000, "revisit", 3), (1, 1000, "revisit", 7), (3, 1000, "response", None), (7, 1000, "response", None), (7, 1000, "response", None)]
    assert {r["record_type"] for r in got if r["payload_bytes"] in (0, 999, 2000)} == {"response"}
    assert warc.read_archives(warc.write_archives(frame.limit(0))).collect() == []


def test_reader_finds_damage():
    row = {"page_id": 1, "url": "u", "html": "hello" * 50_000, "payload_digest": "", "record_type": "response", "refers_to": None}
    import hashlib

    row["payload_digest"] = hashlib.sha1(row["html"].encode()).hexdigest()
    good = warc.record(row)
    read = lambda raw: list(warc.read_archive(io.BytesIO(raw), keep=True))
    assert [r["payload"] for r in read(good * 3)] == [row["html"].encode()] * 3
    for bad in (
        good[:-30],
        warc.record({**row, "payload_digest": "0" * 40}),
        gzip.compress(gzip.decompress(good).replace(b"hello", b"jello", 1)),
        gzip.compress(gzip.decompress(good)[:-10]),
        gzip.compress(gzip.decompress(good) + b"more"),
        gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"),
    ):
        with pytest.raises((ValueError, KeyError)):
            read(bad)


# ------------------------------------------------------------------ decontamination


def brute_leaks(docs, items):
    out = set()
    for d, text in docs:
        w = substring.word_list((text or "").encode())
        for i, item in items:
            v = substring.word_list((item or "").encode())
            if not w or not v:
                continue
            grams = lambda x: [tuple(x[j : j + 5]) for j in range(max(1, len(x) - 4))]
            b = grams(v)
            for s in range(max(1, len(w) - len(v) + 1)):
                a = grams(w[s : s + len(v)])
                common = sum(min(a.count(x), b.count(x)) for x in set(a))
                if common / (len(a) + len(b) - common) >= 0.8:
                    out.add((d, i))
                    break
    return out


def test_leaks_against_brute_force(spark, documents):
    rng = random.Random(5)
    items = [(i, prose(n, 100 + i)) for i, n in enumerate([12, 14, 30, 57, 3, 5, 30])]
    items[6] = (6, items[2][1])  # a tie: two items of one text
    docs = []
    for k in range(60):
        text, (_, item) = prose(rng.randint(0, 120), 500 + k).split(), items[k % 7]
        part = item.split()
        if k % 3 == 0 and len(part) > 20:
            part[rng.randrange(len(part))] = "changed"
        if k % 3 == 1 and len(part) > 20:
            part.insert(rng.randrange(len(part)), "added")
        at = rng.randint(0, len(text))
        docs.append((k, " ".join([*text[:at], *(part if k % 4 else part[2:]), *text[at:]]).replace("w1", "W1")))
    docs += [(60, None), (61, ""), (62, items[3][1]), (63, prose(2000, 9) + " " + items[1][1])]
    benchmark = spark.createDataFrame([*items, (8, None), (9, " ")], "item_id long, text string")
    frame = documents(docs, CLASH)
    want = brute_leaks(docs, items)
    got = decontaminate.contaminated(frame, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want) > 20
    assert all(r["similarity"] >= 0.8 for r in got)
    assert decontaminate.contaminated(frame.limit(0), benchmark).collect() == []
    assert decontaminate.contaminated(frame, benchmark.limit(0)).collect() == []


def test_leaks_in_another_order(spark, documents):
    """Items whose parts stand in another order inside longer documents, against brute force."""
    rng = random.Random(8)
    items, docs = [(i, prose(n, 300 + i)) for i, n in enumerate([60, 60, 40, 70])], []
    for k in range(12):
        part = items[k % 4][1].split()
        cuts = sorted(rng.sample(range(5, len(part) - 5), 1 + k % 2))
        parts = [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])][::-1]
        docs.append((k, " ".join([prose(rng.randint(20, 40), 400 + k), *[" ".join(p) for p in parts], prose(rng.randint(20, 40), 500 + k)])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(documents(docs), benchmark).collect()
    want = brute_leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want) > 5


def test_leaks_when_the_benchmark_is_large(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "FEW_SHINGLES", 0)
    item = prose(30, 1)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.contaminated(documents([(None, "a b " + item), (2, prose(80, 3)), (3, item), (3, item)]), benchmark)
    assert sorted((r["doc_id"] or 0, r["start"], r["words"]) for r in got.collect()) == [(0, 2, 30), (3, 0, 30)]


# ------------------------------------------------------------------ packing and ids


@pytest.mark.parametrize("total", [1, 2047, 2048, 2049, 4096, 5000])
def test_cut(total):
    parts = packing.cut(total, 2048)
    assert sum(n for _, n in parts) == total and all(n == 2048 for _, n in parts[1:])
    assert [a for a, _ in parts] == np.cumsum([0, *[n for _, n in parts[:-1]]]).tolist()


def test_plans_hold_every_piece():
    rng = random.Random(0)
    for histogram in (
        {1: 5000}, {2048: 7}, {1025: 9, 1023: 4}, {683: 100, 682: 50, 2000: 3},
        {rng.randint(1, 2048): rng.randint(1, 300) for _ in range(500)},
    ):
        groups = packing.plan(histogram, rounds=60)
        held = {}
        for count, pattern in groups:
            assert count > 0 and sum(n * k for n, k in pattern) <= 2048
            for n, k in pattern:
                held[n] = held.get(n, 0) + count * k
        assert held == histogram
        least = -(-sum(n * c for n, c in histogram.items()) // 2048)
        halves = sum(c for n, c in histogram.items() if n > 1024)
        assert sum(c for c, _ in groups) <= max(least, halves) * 1.1 + 1


def test_the_program_places_most_tokens():
    """What best fit gets is a small rest, and the sequences are near the least that can hold the tokens."""
    lengths = np.random.default_rng(0).lognormal(5.5, 1, 4000).astype(int).clip(1, 2047).tolist()
    histogram = {n: lengths.count(n) for n in set(lengths)}
    groups, left = packing.by_program(histogram, 2048)
    tokens = sum(lengths)
    held = dict(left)
    for count, pattern in groups:
        assert sum(n * k for n, k in pattern) >= packing.FULL * 2048
        for n, k in pattern:
            held[n] = held.get(n, 0) + count * k
    assert held == histogram
    assert sum(n * c for n, c in left.items()) < 0.1 * tokens
    assert sum(c for c, _ in packing.plan(histogram)) <= -(-tokens // 2048) + 2
    for small, least in (({1025: 9, 1023: 4}, 9), ({683: 100, 682: 50, 2000: 3}, 53), ({1024: 5}, 3), ({1: 5000}, 3)):
        assert sum(c for c, _ in packing.plan(small)) == least


def test_packing_odd_rows(odd, empty, vocabulary):
    rows = packing.pack_documents(odd, vocabulary).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    assert {r["length"] for r in rows if r["doc_id"] in (0, 1)} == {1}
    assert packing.pack_documents(empty, vocabulary).collect() == []


def test_encoder_agrees_with_whole_texts(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    rng = random.Random(0)
    texts = [t for t in ODD if t is not None] + [" ", "a  b", "a \n b", "x\n\n y", "\n lead", "tail \n", "a  b", "don't I'll ' s", "<|endoftext|> x", "a <|endoftext|> b", "a<|endoftext|><|endoftext|>  b <|endoftext|>", "1 234 !! ..  é"]
    texts += ["".join(rng.choice(["a", "B", " ", " ", "\n", "\t", "1", "!", "é", "　", "'s", "\x1c"]) for _ in range(60)) for _ in range(200)]
    got = Encoder(vocabulary).encode(pa.array([*texts, None]))
    for text, ids in zip([*texts, ""], got):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_word_is_learnt_once_whatever_marks_follow(vocabulary):
    from tokenizers import Tokenizer

    tokenizers_kept = vars(__import__("tokenizers")).get("_pieces_by_file", {})
    tokenizers_kept.pop(vocabulary, None)
    encoder = Encoder(vocabulary)
    texts = ["so qwzzx, then qwzzx. Qwzzx! don't dog's d'll, x' foo<|endoftext|>bar foo<|endoftext|>", "é, é\u0301, über²x a²; ß!\x1cb x_y, 1a a1. ﬁ, Ωmega, word.\nNext.\n\nD"]
    got = encoder.encode(pa.array(texts))
    tokenizer = Tokenizer.from_file(vocabulary)
    assert [ids.tolist() for ids in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert "qwzzx" in encoder.pieces  # learnt without its marks


def test_shards_odd_rows(odd, empty, vocabulary, spark):
    manifest = tokenized.write_shards(odd, vocabulary, shard_ids=500)
    assert manifest.count() > 1
    rows = sorted(tokenized.read_shards(manifest).collect(), key=lambda r: r["start"])
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert len(rows) == 13 and keys == sorted(keys)
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows[:-1]]]).tolist()
    first = min(manifest.collect(), key=lambda r: (r["partition"], r["number"]))
    found = tokenized.lookup(first, [0, 1, 10**12])
    assert found[0].tolist() == [0] and found[2] is None
    assert tokenized.token_table(spark, empty, vocabulary).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.zeros(n, tokenized.KEY)
        keys["key"] = rng.choice(10**9, n, replace=False)
        counts = rng.integers(1, 9, n)
        offsets = np.cumsum(counts) - counts
        index = tokenized.ShardIndex(tokenized.encode_index(keys, offsets, counts, 2))
        assert sorted(index.perfect.slots(tokenized.key_hash(keys, index.seed)).tolist()) == list(range(n))
        here, at, size = index.find(keys)
        assert here.all() and (at == offsets).all() and (size == counts).all()
        strange = np.zeros(1000, tokenized.KEY)
        strange["key"] = -1 - np.arange(1000)
        assert index.find(strange)[0].sum() <= 1


# ------------------------------------------------------------------ substrings


def test_chains_are_best():
    rng = random.Random(2)
    for _ in range(30):
        parts = np.array([(rng.randint(0, 80), rng.randint(0, 80), rng.randint(3, 12)) for _ in range(7)])
        best = 0.0
        for mask in range(1, 1 << 7):
            own = sorted((parts[i] for i in range(7) if mask >> i & 1), key=lambda f: (f[0], f[1]))
            score, ok = float(own[0][2]), True
            for f, g in zip(own, own[1:]):
                da, db = g[0] - f[0] - f[2], g[1] - f[1] - f[2]
                ok &= da >= 0 and db >= 0
                score += g[2] - substring.GAP_COST * (da + db)
            best = max(best, score) if ok else best
        found = substring.chains(parts, reach=10**6)[0]
        gaps = sum((g[0] - f[0] - f[2]) + (g[1] - f[1] - f[2]) for f, g in zip(found, found[1:]))
        assert np.isclose(found[:, 2].sum() - substring.GAP_COST * gaps, best)


def test_passages(documents):
    passage = prose(70, 77)
    edited = passage.split()
    edited[20], edited[45] = "changed", "again"
    del edited[60]
    texts = [
        prose(100, 1) + " " + passage + " " + prose(90, 2),
        prose(33, 3) + " " + passage.upper() + " " + prose(44, 4),
        " ".join(edited) + " " + prose(60, 5),
        prose(400, 6),
        passage[: passage.index(" ", 90)] + " " + prose(300, 7),  # far shorter than a passage
        "again and again " * 200,
        None,
        "",
    ]
    docs = documents([*enumerate(texts), (None, passage), (1, texts[1])], ["a", "seed", "place", "mark"])
    rows = substring.repeated_passages(docs).collect()
    found = {r["doc_id"]: r for r in rows}
    assert set(found) == {1, 2} and {r["source_id"] for r in rows} == {0}
    assert (found[1]["start"], found[1]["end"]) == (33, 103) and found[1]["similarity"] == 1
    assert found[2]["start"] == 0 and found[2]["end"] in (69, 68, 70)
    kept = {r["doc_id"]: r["text"] for r in substring.without_repeats(docs.where("doc_id IS NULL OR doc_id <> 1")).collect()}
    assert kept[0] == texts[0] and kept[3] == texts[3] and kept[2] == prose(60, 5) and None in kept
    assert substring.repeated_passages(docs.limit(0)).collect() == []


def test_copies_need_no_pairs(spark, documents):
    text = prose(120, 8)
    docs = documents([(i, text) for i in range(300)])
    rows = substring.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["source_id"], r["start"], r["end"]) for r in rows} == {(i, 0, 0, 120) for i in range(1, 300)}
    assert [r["doc_id"] for r in substring.without_repeats(docs).collect()] == [0]


def test_cut_words_keeps_the_rest():
    raw = "A b\tc\nd  e é f".encode()
    assert substring.cut_words(raw, [(1, 3)]) == "A d  e é f".encode()
    assert substring.cut_words(raw, [(0, 2), (4, 99)]) == b"c\nd  "
    assert substring.cut_words(raw, []) == raw


def test_runs_that_stand_alone_are_those_alignment_ends_at():
    rng = random.Random(12)
    for _ in range(3000):
        x = [rng.randint(0, 2) for _ in range(rng.randint(6, 30))]
        y = [rng.randint(0, 2) for _ in range(rng.randint(6, 30))]
        n = rng.randint(1, 5)
        a, b = rng.randint(0, len(x) - n), rng.randint(0, len(y) - n)
        y[b : b + n] = x[a : a + n]
        ((i, u, j, v, matched),) = substring.align(x, y, [(a, b, n)])
        alone = substring._stands_alone(np.array(x, "<u2").tobytes(), np.array(y, "<u2").tobytes(), a, b, n, 99)
        run = u - i == v - j == matched and x[i:u] == y[j:v]
        assert not alone or run
        assert alone or u - i > n or v - j > n


def test_passages_whose_lines_stand_alone_before(documents):
    """Every five words of the passage stand in an earlier document, the passage in none."""
    passage = prose(60, 901).split()
    rows = [(i, f"{prose(30, 910 + i)} {' '.join(passage[a:b])} {prose(30, 920 + i)}") for i, (a, b) in enumerate([(0, 30), (30, 60), (25, 36)])]
    rows += [(i, f"{prose(40, 930 + i)} {' '.join(passage)} {prose(40, 940 + i)}") for i in (7, 8, 9)]
    got = {(r["doc_id"], r["source_id"]) for r in substring.repeated_passages(documents(rows)).collect() if r["end"] - r["start"] >= 60}
    assert got == {(8, 7), (9, 7)}


@pytest.mark.parametrize("every,length", [(6, 60), (7, 60), (8, 60), (10, 60), (6, 100)])
def test_similar_passages_are_all_found(documents, every, length):
    rows = []
    for n in range(40):
        passage = prose(length, 1000 + n).split()
        changed = [f"new{n}x{i}" if i % every == every - 1 else w for i, w in enumerate(passage)]
        rows += [(2 * n, f"{prose(30, 2000 + n)} {' '.join(passage)}"), (2 * n + 1, f"{' '.join(changed)} {prose(30, 3000 + n)}")]
    got = {(r["doc_id"], r["source_id"]) for r in substring.repeated_passages(documents(rows)).collect()}
    assert got == {(2 * n + 1, 2 * n) for n in range(40)}


def test_chains_over_one_another_share_a_row():
    """A text of one word over and over links each place to the same first one."""
    found = [[(0, place, 5)] for place in range(400)] + [[(9000, 5, 6), (9010, 15, 7)], [(0, 9000, 5)]]
    rows = list(substring._side_by_side(found, 50))
    assert len(rows) == 3 and sorted(c for *_, held in rows for c in held) == sorted(found)
    for a0, a1, b0, b1, held in rows:
        assert substring._chains_in(substring._chains_to(held)) == held
        for chain in held:
            own, (p, q, r, t) = substring._cut_to(chain, a0, b0, 50)
            assert (a0 + p, a0 + q, b0 + r, b0 + t) == substring._window(chain, 50) and min(p, r) >= 0 and q <= a1 - a0 and t <= b1 - b0
            assert [(x + a0 + p, y + b0 + r, n) for x, y, n in own] == chain
    wide = [[(50 * i, 50 * i, 5)] for i in range(200)]
    assert all(b1 - b0 <= substring.REGION for _, _, b0, b1, _ in substring._side_by_side(wide, 50))


def test_slices_are_cut_where_the_texts_lie(spark, documents, monkeypatch):
    """Texts join nothing: what is asked of a chunk comes to it. Slices are the texts' own words."""
    rows = [(i, prose(40 + i, 4000 + i)) for i in range(12)]
    chunks = substring.stored(substring.chunks_of_texts(documents(rows).select("doc_id", "text"), 1000), "chunks")
    texts = substring.stored(substring.numbered_texts(chunks), "texts")
    asked = [(i, j, 10 * (i % 3), 20 + i, 0, 30 + 10 * j) for i in range(12) for j in range(i + 1, 12, 2)]
    pairs = spark.createDataFrame(asked, "a long, b long, a0 long, a1 long, b0 long, b1 long")
    plans, keep = [], substring.stored
    monkeypatch.setattr(substring, "stored", lambda df, name: (plans.append(df._jdf.queryExecution().toString()), keep(df, name))[1])
    words = {tid: text.lower().split() for tid, (_, text) in enumerate(rows)}  # numbered by doc_id
    for coded in (False, True):
        got = {tuple(r[c] for c in pairs.columns): (bytes(r["left"]), bytes(r["right"])) for r in substring._slices(chunks, texts, pairs, coded)[0].collect()}
        cut = lambda t, x, y: substring.word_codes([w.encode() for w in words[t][x:y]]) if coded else " ".join(words[t][x:y]).encode()
        assert got == {(a, b, *at): (cut(a, *at[:2]), cut(b, *at[2:])) for a, b, *at in asked}
    assert plans and not any("posexplode(texts" in plan or "Join" in plan for plan in plans)


def test_fragments_of_many_pairs_are_those_of_each():
    rng = np.random.default_rng(5)
    pair = np.sort(rng.integers(0, 20, 300))
    a, b, words = rng.integers(0, 40, 300), rng.integers(0, 40, 300), rng.integers(5, 9, 300)
    together = substring.fragments(pair, a, b, words, 1)
    alone = [substring.fragments(pair[pair == p], a[pair == p], b[pair == p], words[pair == p], 1) for p in np.unique(pair)]
    assert (together == np.concatenate(alone)).all()
    for p, x, y, n in together.tolist():  # a fragment is made of matches on its diagonal
        on = (pair == p) & (b - a == y - x) & (b >= y) & (b + words <= y + n)
        assert b[on].min() == y and (b + words)[on].max() == y + n
