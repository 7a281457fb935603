"""Feature tables built chunk by chunk, with a manifest that says which chunks are up to date.

A chunk is all rows with one value of the chunk keys; it must hold whole plays. Its entry in the
manifest (rows, and two sums over the rows' hashes) is published after all tables hold the chunk.
A chunk without an entry, or whose rows no longer give the sums of its entry, is built anew: an
interrupted run goes on where it stopped, and rows that arrive late are not passed over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmotion.plans.tables import players_table, plays_table, teamframe_table
from gridmotion.schemas import PLAY_KEYS
from gridmotion.session import checkpointed
from gridmotion.sources import files

TABLES = ("players", "teamframe", "plays")
STATE = ["n_rows", "digest_sum", "digest_xor"]


def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def chunk_states(rows: DataFrame, chunk_keys: list[str]) -> DataFrame:
    """(chunk keys, n_rows, digest_sum, digest_xor): equal for equal rows, in whatever order they lie."""
    digest = F.xxhash64(*sorted(rows.columns))
    return rows.groupBy(*chunk_keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(digest.cast("decimal(38,0)")).alias("digest_sum"),
        F.bit_xor(digest).alias("digest_xor"),
    )


def published(spark: SparkSession, out: str, chunk_keys: list[str]) -> DataFrame | None:
    """The latest manifest entry of each chunk, or None before the first."""
    path = f"{out}/manifest"
    if not files.path_exists(spark, path):
        return None
    entry = F.max(F.struct("run", *STATE)).alias("e")
    return spark.read.parquet(path).groupBy(*chunk_keys).agg(entry).select(*chunk_keys, "e.*")


def pending_chunks(rows: DataFrame, out: str, chunk_keys: list[str]) -> DataFrame:
    """States of the chunks that are new or changed since their entry."""
    spark, states = rows.sparkSession, chunk_states(rows, chunk_keys)
    known = published(spark, out, chunk_keys)
    if known is None:
        return states
    same = reduce(lambda a, b: a & b, [F.col(f"now.{c}") == F.col(f"then.{c}") for c in STATE])
    return states.alias("now").join(known.alias("then"), _same("now", "then", chunk_keys) & same, "left_anti")


def _write(table: DataFrame, path: str, chunk_keys: list[str]) -> None:
    """Replace the chunks that are in the table; others stay."""
    table.hint("rebalance", *chunk_keys).write.partitionBy(*chunk_keys).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def build_in_chunks(
    spark: SparkSession, tracking: DataFrame, out: str, chunk_keys: list[str] = ("week",), stop_before: str | None = None
) -> dict[str, str]:
    """Bring players, teamframe and plays up to date; {table: path}.

    stop_before names a table, or "manifest", before which the run ends, as if it were interrupted.
    """
    chunk_keys = list(chunk_keys)
    paths = {name: f"{out}/{name}" for name in TABLES}
    pending = checkpointed(pending_chunks(tracking, out, chunk_keys))
    if pending.isEmpty():
        return paths
    rows = tracking.alias("rows").join(pending.select(*chunk_keys).alias("due"), _same("rows", "due", chunk_keys), "left_semi")
    extra = tuple(k for k in chunk_keys if k not in PLAY_KEYS)
    chunk_of = rows.select(*PLAY_KEYS, *extra).distinct()
    crossing = chunk_of.groupBy(*PLAY_KEYS).count().where("count > 1").limit(1).collect()
    if crossing:
        raise ValueError(f"a play lies in several chunks by {chunk_keys}: {tuple(crossing[0])[:-1]}")

    def due(name: str) -> DataFrame:
        stored = spark.read.parquet(paths[name]).alias("rows")
        return stored.join(pending.select(*chunk_keys).alias("due"), _same("rows", "due", chunk_keys), "left_semi").drop(*extra)

    # The play table is made from the stored rows of the other two.
    makers = {
        "players": lambda: players_table(rows, keep=extra),
        "teamframe": lambda: teamframe_table(rows, keep=extra),
        "plays": lambda: plays_table(due("players"), due("teamframe")).join(chunk_of, PLAY_KEYS),
    }
    for name in TABLES:
        if stop_before == name:
            return paths
        _write(makers[name](), paths[name], chunk_keys)
    if stop_before != "manifest":
        known = published(spark, out, chunk_keys)
        run = 1 if known is None else 1 + (known.agg(F.max("run")).first()[0] or 0)
        pending.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{out}/manifest")
    return paths
