"""Finding passages of benchmark items in documents.

A window has as many words as the item it is held against. Windows are placed at every start from
which so many of the window's shingles stand in the item, in any order, as the similarity asked
for needs; no other window can pass. Every window and item has a SimHash fingerprint of its
shingles. A multi-index over blocks of the fingerprint finds all items within the Hamming
radius: with m blocks and a radius below m * (t + 1), one block differs in at most t bits, and
every item is listed under all block values that near. What is found is then compared exactly,
by the shingles of both sides weighted by how often they occur. All of it is DataFrame
operations.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmotion.llm.common import stored, words

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1  # the largest radius the blocks guarantee
FEW_SHINGLES = 500_000  # item shingles sent to every task, 20 MB; more are joined by a shuffle
FEW_RANGES = 200_000  # ranges of window starts sent to every task


def _hashes(w: Column, size: int) -> Column:
    """64-bit hashes of the shingles of at least `size` words."""
    at = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)])
    return F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), at)).otherwise(
        F.array().cast("array<bigint>")
    )


def _shingles(w: Column, size: int) -> Column:
    """Shingles as texts; a shorter word sequence is one shingle."""
    many = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.concat_ws(" ", F.slice(w, i + 1, size)))
    return F.when(F.size(w) >= size, many).otherwise(F.array(F.concat_ws(" ", w)))


def _fingerprints(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """SimHash of the shingles of the text column `passage`, repeats included."""
    # The words are a column of their own: within the shingles they would be split anew each time.
    split = rows.select(*keys, F.split("passage", " ").alias("pw"))
    hashed = split.select(*keys, F.explode(_shingles(F.col("pw"), size)).alias("s")).select(
        *keys, F.xxhash64("s").alias("h")
    )
    ones = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(64)]
    counted = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *ones)
    fp = F.lit(0).cast("long")
    for b in range(64):
        bit = 1 << b if b < 63 else -(1 << 63)
        fp = fp.bitwiseOR(F.when(F.col(f"b{b}") * 2 > F.col("n"), F.lit(bit)).otherwise(F.lit(0)).cast("long"))
    return counted.select(*keys, fp.alias("fp"))


def _block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of a window and an item of its length within RADIUS bits, by the multi-index."""
    masks = [
        sum(1 << i for i in bits) for n in range(BLOCK_RADIUS + 1) for bits in combinations(range(BLOCK_BITS), n)
    ]
    entry = lambda fp: F.explode(F.array(*[F.struct(F.lit(b).alias("b"), _block(fp, b).alias("v")) for b in range(BLOCKS)]))
    listed = items.select("item", "length", F.col("fp").alias("item_fp"), entry(F.col("fp")).alias("e"))
    listed = listed.select("item", "length", "item_fp", F.col("e.b").alias("b"), F.col("e.v").alias("v"), F.explode(F.array(*map(F.lit, masks))).alias("m"))
    listed = listed.select("item", "length", "item_fp", "b", F.col("v").bitwiseXOR(F.col("m")).alias("v"))
    asked = windows.select("length", "passage", "fp", entry(F.col("fp")).alias("e")).select(
        "length", "passage", "fp", F.col("e.b").alias("b"), F.col("e.v").alias("v")
    )
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # Neither side is bounded, so the join may not turn into a broadcast at run time.
    met = asked.hint("merge").join(listed, ["length", "b", "v"]).withColumn("bits", bits).where(F.col("bits") <= RADIUS)
    return met.select("length", "passage", "item", "bits").distinct()


def _key(text: str) -> Column:
    return F.md5(text).alias(f"{text}_key")


def _similarities(pairs: DataFrame, size: int) -> DataFrame:
    """(passage_key, item_key, similarity): common over joint weight, a shingle weighing its occurrences."""

    def counted(side: str) -> DataFrame:
        texts = pairs.select(f"{side}_key", side).dropDuplicates([f"{side}_key"])
        split = texts.select(f"{side}_key", F.split(side, " ").alias("w"))
        shingles = split.select(f"{side}_key", F.explode(_shingles(F.col("w"), size)).alias("s"))
        counts = shingles.groupBy(f"{side}_key", "s").agg(F.count(F.lit(1)).alias(f"{side}_n"))
        return stored(counts, f"{side}-shingles")

    left, right = counted("passage"), counted("item")
    both = pairs.select("passage_key", "item_key")
    met = both.join(left, "passage_key").join(right, ["item_key", "s"])
    common = met.groupBy("passage_key", "item_key").agg(F.sum(F.least("passage_n", "item_n")).alias("common"))
    sizes = [c.groupBy(f"{n}_key").agg(F.sum(f"{n}_n").alias(f"{n}_all")) for c, n in ((left, "passage"), (right, "item"))]
    told = common.join(sizes[0], "passage_key").join(sizes[1], "item_key")
    joint = F.col("passage_all") + F.col("item_all") - F.col("common")
    return told.select("passage_key", "item_key", (F.col("common") / joint).alias("similarity"))


def _start_ranges(met: DataFrame, size: int, similarity: float) -> DataFrame:
    """(doc_id, row, length, lo, hi): the starts from which a window can be as similar as asked for.

    met: (doc_id, row, words, key, length, at), a place where a document of so many words holds a
    shingle of `size` words of the item `key`. A window from s holds enough of them if the c-th from
    the first at or after s lies in it; the ranges of a document and an item are disjoint.
    """
    shingles = F.greatest(F.col("length") - size + 1, F.lit(1))
    own = F.least(shingles, F.greatest(F.col("words") - size + 1, F.lit(1)))  # of a short document: fewer
    need = F.ceil((shingles + own) * similarity / (1 + similarity) - 1e-9).cast("int")
    listed = met.groupBy("doc_id", "row", "words", "key", "length").agg(F.sort_array(F.collect_set("at")).alias("p"))
    listed = listed.withColumn("c", F.greatest(need, F.lit(1))).where(F.size("p") >= F.col("c"))
    p, last = F.col("p"), F.greatest(F.col("words") - F.col("length"), F.lit(0))
    ranges = F.transform(
        F.sequence(F.lit(0), F.size("p") - F.col("c")),
        lambda i: F.struct(
            F.greatest(F.get(p, i + F.col("c") - 1) - shingles + 1, F.coalesce(F.get(p, i - 1), F.lit(-1)) + 1, F.lit(0)).alias("lo"),
            F.least(F.get(p, i), last).alias("hi"),
        ),
    )
    found = listed.select("doc_id", "row", "length", F.explode(F.filter(ranges, lambda r: r["lo"] <= r["hi"])).alias("r"))
    return found.select("doc_id", "row", "length", "r.lo", "r.hi")


def text_row(text: Column) -> Column:
    """Tells documents with the same doc_id, or with none, apart by their text."""
    return F.xxhash64(text)


def _matches(docs: DataFrame, benchmark: DataFrame, size: int, similarity: float) -> DataFrame:
    """(doc_id, row, item_id, best) with the best window of each document and item."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0)
    items = items.select("item_id", "w", F.size("w").alias("length"), F.concat_ws(" ", "w").alias("item"))
    items = stored(items, "items")
    sizes = sorted(r[0] for r in items.select(F.least("length", F.lit(size))).distinct().collect())  # `size` rows at most
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_row(F.col("text")).alias("row"),
        words(F.col("text")).alias("w"),
    )
    ranges = None
    for s in sizes:
        mine = items.where(F.least("length", F.lit(size)) == s)
        marks = mine.select(F.xxhash64("item").alias("key"), "length", F.explode(_hashes(F.col("w"), s)).alias("h")).distinct()
        few = marks.limit(FEW_SHINGLES + 1).count() <= FEW_SHINGLES
        places = rows.select("doc_id", "row", F.size("w").alias("words"), F.posexplode(_hashes(F.col("w"), s)).alias("at", "h"))
        met = places.join(F.broadcast(marks) if few else marks, "h")  # size checked
        found = _start_ranges(met, s, similarity)
        ranges = found if ranges is None else ranges.union(found)
    if ranges is None:
        ranges = rows.where("false").select("doc_id", "row", *[F.lit(0).alias(c) for c in ("length", "lo", "hi")])
    ranges = stored(ranges.distinct(), "ranges")
    asked = ranges.select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "length", "lo", "hi")
    if asked.limit(FEW_RANGES + 1).count() <= FEW_RANGES:
        asked = F.broadcast(asked)  # size checked
    hits = rows.join(asked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")))
    hits = hits.select("doc_id", "row", "w", "length", F.explode(F.sequence("lo", "hi")).alias("start"))
    hits = hits.select(
        "doc_id", "row", "length", "start", F.concat_ws(" ", F.slice("w", F.col("start") + 1, F.col("length"))).alias("passage")
    ).distinct()
    hits = stored(hits, "windows")
    windows = _fingerprints(hits.select("length", "passage").distinct(), ["length", "passage"], size)
    prints = _fingerprints(items.select("item", "length", F.col("item").alias("passage")).distinct(), ["item", "length"], size)
    # Stored before they are compared: a filter on the similarity would else be pushed into the join.
    pairs = stored(_within_radius(windows, prints).select("length", "passage", "item", "bits", _key("passage"), _key("item")), "pairs")
    scored = _similarities(pairs, size)
    good = pairs.join(scored.where(F.col("similarity") >= similarity), ["passage_key", "item_key"])
    good = good.hint("merge").join(items.select("item_id", "item"), "item").select(
        "length", "passage", "item_id", "bits", "similarity"
    )
    return hits.join(good.hint("merge"), ["length", "passage"]).groupBy("doc_id", "row", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("s"), "bits", "length")).alias("best")
    )


def leaking_rows(docs: DataFrame, benchmark: DataFrame, size: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, row) of the documents that hold a window like a benchmark item."""
    return _matches(docs, benchmark, size, similarity).select("doc_id", "row").distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = SHINGLE_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """Documents (doc_id, text) that hold a window like a benchmark item (item_id, text).

    Returns doc_id, item_id, similarity, bits, start and words: the best window (the first of
    the best) for each document and item. Words are lower-cased in A-Z; an item shorter than a
    shingle is one shingle; a document shorter than the item is one window. Items and documents
    without words (null, empty) match nothing; null ids are kept; documents that share a doc_id
    are told apart by their text, and repeated rows count once; other columns are ignored; an
    empty table gives an empty result.
    """
    matches = _matches(docs, benchmark, size, similarity)
    return matches.select(
        "doc_id", "item_id", "best.similarity", F.col("best.bits").cast("int").alias("bits"),
        (-F.col("best.s")).alias("start"), F.col("best.length").alias("words"),
    )
