"""Contiguous shards of whole groups whose largest shard is as small as it can be.

Groups (rows of equal text) stand in the order of their digest. The smallest capacity that
lets a greedy pass close the line of groups within the given number of shards is found by
binary search; the greedy pass under that capacity says where to cut. The groups are never
gathered: cuts are looked up on their running totals, which are stored in order, and a search
step tries many capacities at once. Once the groups that any remaining capacity could cut at
are few, the search ends on those alone.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.llm.common import stored

SHARDS = 8
AT_ONCE = 15  # capacities tried by one step of the search
FEW = 50_000  # cut places with which the search ends on the driver
BUCKETS = 4096
ROWS_EACH = 50_000


def _digest(text: Column) -> Column:
    return F.coalesce(F.md5(text), F.lit("null"))


def totals(groups: DataFrame) -> DataFrame:
    """Running totals of (digest, size) groups in digest order, bucket by bucket."""
    bucket = F.coalesce(F.conv(F.substring("digest", 1, 3), 16, 10).cast("int"), F.lit(BUCKETS))
    rows = groups.withColumn("bucket", F.when(F.col("digest") == "null", BUCKETS).otherwise(bucket))
    sums = rows.groupBy("bucket").agg(F.sum("size").alias("all"))  # 4097 rows at most
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("bucket", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bucket").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.join(F.broadcast(base), "bucket")
    return ends.select("digest", "size", (F.col("base") + F.sum("size").over(inside)).alias("end"))


def _furthest(ends: DataFrame, reach: list[int], start: list[int]) -> list[int]:
    """For each limit, the last group end that does not pass it (the start, if none does)."""
    near = F.lit(False)
    for r, s in zip(reach, start):
        near = near | F.col("end").between(s, r)
    found = ends.where(near).agg(
        *[F.max(F.when(F.col("end") <= r, F.col("end"))).alias(f"m{i}") for i, r in enumerate(reach)]
    ).first()
    return [max(s, found[i] or 0) for i, s in enumerate(start)]


def _greedy(ends: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """Where a greedy pass cuts under each capacity."""
    cuts = [[0] for _ in capacities]
    for _ in range(shards):
        last = [c[-1] for c in cuts]
        for c, at in zip(cuts, _furthest(ends, [a + b for a, b in zip(last, capacities)], last)):
            c.append(at)
    return cuts


def minimax_cuts(ends: DataFrame, shards: int, few: int = FEW) -> list[int]:
    """Ends of the shards under the smallest feasible capacity.

    ends: rows (size, end), sizes of at least 1. Shards may be empty at the end.
    """
    total, largest = ends.agg(F.max("end"), F.max("size")).first()
    if total is None:
        return [0] * shards
    low = max(-(-total // shards), largest) - 1  # the largest capacity known not to do
    high = low + largest  # does: every shard but the last can be filled to more than the mean
    low_cuts, high_cuts = _greedy(ends, [low, high], shards)
    while True:
        near = F.lit(False)
        for a, b in zip(low_cuts[1:], high_cuts[1:]):
            near = near | F.col("end").between(a, b)
        places = ends.where(near).select("end")
        if places.limit(few + 1).count() <= few:
            break
        step = max(1, (high - low) // (AT_ONCE + 1))
        tried = list(range(low + step, high, step))[:AT_ONCE]
        if not tried:  # high is the smallest feasible capacity
            return high_cuts[1:]
        for capacity, cuts in zip(tried, _greedy(ends, tried, shards)):
            if cuts[-1] >= total:
                high, high_cuts = capacity, cuts
                break
            low, low_cuts = capacity, cuts
    known = sorted({r[0] for r in places.collect()} | {0})

    def cuts_of(capacity: int) -> list[int]:
        cuts = [0]
        for _ in range(shards):
            cuts.append(max(cuts[-1], known[bisect_right(known, cuts[-1] + capacity) - 1]))
        return cuts

    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if cuts_of(middle)[-1] >= total else (middle, high)
    return cuts_of(high)[1:] if high_cuts[-1] >= total else high_cuts[1:]


def shard_documents(docs: DataFrame, shards: int = SHARDS, rows_each: int = ROWS_EACH) -> DataFrame:
    """Put every row of docs (doc_id, text) into a shard of nearly equal bytes.

    Rows of equal text stay together. A null text is a group of its own with size 1 per row
    and no checksum; a null doc_id is kept; repeated rows are counted and dealt out again, each
    with a slot of its own; other columns are ignored; an empty table gives an empty result.
    Slots run from 0 within a shard without gaps.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        _digest(F.col("text")).alias("digest"),
    )
    # Copies of a whole row are one entry with a count, so no hot row meets a window.
    entries = stored(
        rows.groupBy("doc_id", "size", "text_crc32", "digest").agg(F.count(F.lit(1)).alias("times")), "entries"
    )
    groups = entries.groupBy("digest").agg(F.sum(F.col("size") * F.col("times")).alias("size"))
    ends = stored(totals(groups).repartitionByRange("end").sortWithinPartitions("end"), "group-ends")
    cuts = minimax_cuts(ends, shards)
    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard = shard + (F.col("end") > cut).cast("int")
    # The cuts fall between digests, so each shard is a range of digests.
    first = (
        ends.groupBy(shard.alias("shard")).agg(F.min("digest").alias("first"), F.max("digest").alias("last")).collect()
    )  # one row a shard
    if not first:
        placed = entries.withColumn("shard", F.lit(0))
    else:
        pick = F.lit(None).cast("int")
        for r in sorted(first, key=lambda r: r["shard"]):
            pick = F.when(F.col("digest").between(r["first"], r["last"]), r["shard"]).otherwise(pick)
        placed = entries.withColumn("shard", pick)
    salts = max(1, -(-entries.count() // rows_each))
    salted = placed.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(salts)))
    order = ["doc_id", "digest"]
    before = Window.partitionBy("shard", "__salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = salted.withColumn("__n", F.coalesce(F.sum("times").over(before), F.lit(0)))
    sizes = salted.groupBy("shard", "__salt").agg(F.sum("times").alias("__c"))
    upto = Window.partitionBy("shard").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col("shard").alias("__h"), F.col("__salt").alias("__s"), F.coalesce(F.sum("__c").over(upto), F.lit(0)).alias("__base")
    )
    joined = numbered.join(bases, (F.col("shard") == F.col("__h")) & (F.col("__salt") == F.col("__s")))
    copies = joined.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("times").cast("int") - 1)))
    return copies.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("__base") + F.col("__n") + F.col("__copy")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
