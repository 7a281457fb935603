"""How document filters interact: what each removes at each place of each order.

Every filter leaves a relation of the rows that fail it, one table for each filter. The rows that
survive a prefix of an order are those of the whole table without (left anti join) the relations
of the prefix's filters; what the next filter removes are the rows of its relation that are among
them (left semi join). A prefix counts by the filters in it and not by their order, so five filters have
32 of them. They go through the joins together, as row ids with the name of their prefix, so ten
joins of ids serve all. Counts of all orders follow from those few removals.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmotion.llm.common import SEPARATORS, stored


def text_failures() -> dict[str, Column]:
    """Failure conditions of a text (null is empty) for the filters that need nothing else."""
    text = F.col("text")
    size, capitals = F.length(text), F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * capitals.cast("long") > 3 * size.cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _failing(docs: DataFrame) -> DataFrame:
    """(row, doc_id, part, digest, A, B, C, D) of every row of docs, stored; `row` numbers the rows."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("__w", F.array_remove(F.split("text", SEPARATORS), ""))
    rows = rows.withColumns(
        {"n_words": F.size("__w").cast("long"), "n_distinct": F.size(F.array_distinct("__w")).cast("long")}
    ).drop("__w")
    failures = [c.alias(name) for name, c in text_failures().items()]
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "part", F.sha2("text", 256).alias("digest"), *failures
    )
    return stored(rows, "failures")


def _repeats(rows: DataFrame) -> DataFrame:
    """Rows whose text stands under a smaller doc_id too. A null doc_id is neither smaller nor larger."""
    # Combined before the shuffle; only texts under several ids are joined, one row for each.
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("__first"), F.max("doc_id").alias("__last")
    ).where("__first < __last").drop("__last")
    return rows.join(stored(first, "repeated-texts"), "digest").where("doc_id > __first").select("row")


def survivors(everyone: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """Rows of everyone (with a `row`) once for each prefix they survive, with that prefix.

    Filters of a prefix stand in alphabetical order; a prefix of all filters has no step after it
    and is left out. Each filter extends the prefixes of the earlier ones by one join.
    """
    letters, tables = sorted(failing), [stored(everyone.withColumn("prefix", F.lit("")), "survivors")]
    for f in letters:
        before = reduce(DataFrame.union, tables).where(F.length("prefix") < len(letters) - 1)
        left = before.join(failing[f], "row", "left_anti")
        tables.append(stored(left.withColumn("prefix", F.concat("prefix", F.lit(f))).select(*tables[0].columns), "survivors"))
    return reduce(DataFrame.union, tables)


def removals(everyone: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """(prefix, step_filter, part, removed, good_lost, toxic_lost) for each prefix and each further filter.

    everyone: (row, part, good, toxic); failing: relations with a `row`. Where a filter removes
    nothing there is no row.
    """
    left, parts = survivors(everyone, failing), []
    for f in sorted(failing):
        gone = left.where(~F.contains("prefix", F.lit(f))).join(failing[f], "row", "left_semi")
        parts.append(
            gone.groupBy("prefix", "part").agg(
                F.count(F.lit(1)).alias("removed"),
                F.sum(F.col("good").cast("long")).alias("good_lost"),
                F.sum(F.col("toxic").cast("long")).alias("toxic_lost"),
            ).select("prefix", F.lit(f).alias("step_filter"), "part", "removed", "good_lost", "toxic_lost")
        )
    return reduce(DataFrame.union, parts)


def interaction_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of each step of each order of the five filters, for each part (lang) of docs.

    Returns part, filter_order, step (from 1), kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley (what the step's filter removes, over all orders). A null text is empty
    and a null lang the part ''; a row is good or toxic if any label of its doc_id says 1. A null
    doc_id has no label, and its text is no copy of a smaller one; repeated rows count one by one,
    and rows of one text under one doc_id are no copies of each other; texts are taken whole. Other
    columns are ignored; an empty table has no parts and gives an empty result.
    """
    spark = docs.sparkSession
    rows = _failing(docs)
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL")
    said = said.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    no = F.lit(False)
    marked = rows.join(said, "doc_id", "left").select(
        "row", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )
    failing = {f: stored(rows.where(f).select("row"), f"fails-{f}") for f in text_failures()}
    failing["E"] = stored(_repeats(rows), "fails-E")
    letters = sorted(failing)
    gone = stored(removals(marked, failing), "removals")
    totals = stored(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "parts")

    # From here on a few rows for each part: the removals of 80 sets, spread over 600 steps.
    weight = {n: factorial(n) * factorial(len(letters) - 1 - n) for n in range(len(letters))}
    worth = reduce(lambda a, n: F.when(F.length("prefix") == n, weight[n]).otherwise(a), weight, F.lit(0))
    alone = F.sum(F.when(F.length("prefix") == len(letters) - 1, F.col("removed")))
    whole = F.sum(F.when(F.col("prefix") == "", F.col("removed")))
    by_filter = gone.groupBy("part", "step_filter").agg(
        whole.alias("fails"), alone.alias("unique_fails"), F.sum(F.col("removed") * worth).alias("shapley")
    )
    steps, before = [], []
    for order in permutations(letters):
        for n, f in enumerate(order):
            steps.append(("".join(order), n + 1, "".join(sorted(order[:n])), f))
    for prefix in {s[2] for s in steps} | {"".join(letters)}:
        before += [(prefix, "".join(sorted(prefix[:n])), f) for n, f in enumerate(prefix)]
    plan = spark.createDataFrame(steps, "filter_order string, step int, prefix string, step_filter string")
    chain = spark.createDataFrame(before, "upto string, prefix string, step_filter string")
    # What a set of filters removes: the removals of its filters, one after the other.
    sets = gone.join(F.broadcast(chain), ["prefix", "step_filter"]).groupBy("part", "upto").agg(F.sum("removed").alias("so_far"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    grid = totals.join(F.broadcast(plan), how="inner", on=F.lit(True))  # 600 steps for each part
    grid = grid.join(gone, ["part", "prefix", "step_filter"], "left").join(by_filter, ["part", "step_filter"], "left")
    grid = grid.join(sets.withColumnRenamed("upto", "prefix"), ["part", "prefix"], "left")
    removed, earlier = F.coalesce(F.col("removed"), F.lit(0)), F.coalesce(F.col("so_far"), F.lit(0))
    return grid.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - earlier - removed).cast("long").alias("kept"),
        zero("removed"),
        (F.coalesce(F.col("fails"), F.lit(0)) - removed).cast("long").alias("redundant"),
        zero("unique_fails"),
        zero("good_lost"),
        zero("toxic_lost"),
        zero("shapley"),
    )
