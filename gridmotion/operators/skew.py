"""Keeping any one group from landing whole in one task.

Tracking groups are small by nature (22 players a frame, a few hundred frames a
timeline). That is checked, never assumed: the check reads key columns only and
combines on the map side. Groups beyond the limit take a second, exact route.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridmotion.session import checkpointed

GROUP_ROWS = "__group_rows"
MAX_TIMELINE_ROWS = 1_000_000  # a window over more rows is cut into segments
_SEGMENT, _HALO = "__segment", "__halo"
CUTS = 256  # places, even in rows, at which a long timeline may be cut


def _position(df: DataFrame, column: str) -> Column:
    """A column as a number on a line; dates and times become seconds."""
    value = F.col(column)
    if dict(df.dtypes)[column] in ("date", "timestamp_ntz"):
        value = value.cast("timestamp")
    return value.cast("double")


def split_large_groups(
    df: DataFrame, keys: list[str], limit: int
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups up to limit, rows of larger groups with their size, or None).

    Rows whose keys are null are a group like any other, since a window gathers them as one.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(GROUP_ROWS))
    largest = sizes.agg(F.max(GROUP_ROWS)).first()[0]
    if largest is None or largest <= limit:
        return df, None
    large = sizes.where(F.col(GROUP_ROWS) > limit).alias("large")
    names = df.columns
    rows = df.alias("rows")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"rows.{k}").eqNullSafe(F.col(f"large.{k}"))
    small = rows.join(large, condition, "left_anti")
    picked = rows.join(large, condition).select(
        *[F.col(f"rows.{c}").alias(c) for c in names], F.col(f"large.{GROUP_ROWS}")
    )
    return small, picked


def over_timelines(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lookback: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    running: dict[str, Column] | None = None,
    max_rows: int = MAX_TIMELINE_ROWS,
) -> DataFrame:
    """Apply look-back window logic per timeline.

    compute(df, window) adds columns that look at most `lookback` rows back. `running`
    maps a new column to the increment it sums up from the timeline's start; it is null
    where the increment is null. A timeline longer than max_rows is cut into segments by
    the first order column. Each segment gets the last rows before it, and the running
    sums get the totals before it, so the values equal those of one whole window.
    """
    running = running or {}
    whole, long = split_large_groups(df, keys, max_rows)
    window = Window.partitionBy(*keys).orderBy(*order)
    out = compute(whole, window)
    to_here = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, increment in running.items():
        out = out.withColumn(
            name, F.when(increment.isNotNull(), F.sum(increment).over(to_here))
        )
    if long is None:
        return out
    return out.unionByName(
        _over_segments(long, keys, order, lookback, compute, running, max_rows)
    )


def _over_segments(long, keys, order, lookback, compute, running, max_rows):
    columns = [c for c in long.columns if c != GROUP_ROWS]
    position = _position(long, order[0])
    # Cuts lie at quantiles of the order column, so pieces hold like numbers of rows wherever
    # the values lie; a missing order value comes first.
    shares = [i / CUTS for i in range(1, CUTS)]
    cuts = long.groupBy(*keys).agg(
        F.percentile_approx(position, shares, 10_000).alias("__cuts"),
        F.ceil(F.max(GROUP_ROWS) / F.lit(max_rows)).alias("__pieces"),
    )
    named = cuts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__cuts", "__pieces")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    below = F.size(F.filter("__cuts", lambda cut: cut < position))
    piece = F.floor(below * F.least(F.col("__pieces"), F.lit(CUTS)) / F.lit(CUTS))
    rows = long.join(named, same).withColumn(
        "__piece", F.when(position.isNull(), -1).otherwise(piece).cast("bigint")
    )
    rows = rows.select(*columns, "__piece")

    # Number the non-empty pieces: one row per piece, not per frame.
    numbered = rows.groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__n"))
    numbered = numbered.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__piece").alias("__p"),
        F.row_number().over(Window.partitionBy(*keys).orderBy("__piece")).alias(_SEGMENT),
    )
    rows = rows.join(numbered, same & (F.col("__piece") == F.col("__p"))).select(*columns, _SEGMENT)

    segment_keys = [*keys, _SEGMENT]
    newest_first = Window.partitionBy(*segment_keys).orderBy(*[F.desc(c) for c in order])
    tails = (
        rows.withColumn("__recent", F.row_number().over(newest_first))
        .where(F.col("__recent") <= lookback)
        .drop("__recent")
    )
    halo = (
        tails.withColumn("__ahead", F.explode(F.sequence(F.lit(1), F.lit(lookback))))
        .withColumn(_SEGMENT, F.col(_SEGMENT) + F.col("__ahead"))
        .drop("__ahead")
    )
    known = numbered.select(*[F.col(f"__k{i}") for i in range(len(keys))], F.col(_SEGMENT).alias("__s"))
    halo = halo.join(known, same & (F.col(_SEGMENT) == F.col("__s")), "left_semi")
    both = rows.withColumn(_HALO, F.lit(False)).unionByName(halo.withColumn(_HALO, F.lit(True)))
    window = Window.partitionBy(*segment_keys).orderBy(*order)
    out = compute(both, window).where(~F.col(_HALO)).drop(_HALO)
    if running:
        to_here = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = (
            Window.partitionBy(*keys)
            .orderBy(_SEGMENT)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = out.groupBy(*segment_keys).agg(
            *[F.sum(inc).alias(f"__sum_{name}") for name, inc in running.items()]
        )
        carried = carried.select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.col(_SEGMENT).alias("__s"),
            *[
                F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0.0)).alias(f"__carry_{n}")
                for n in running
            ],
        )
        out = out.join(carried, same & (F.col(_SEGMENT) == F.col("__s")))
        for name, increment in running.items():
            total = F.sum(increment).over(to_here) + F.col(f"__carry_{name}")
            out = out.withColumn(name, F.when(increment.isNotNull(), total))
        out = out.drop("__s", *[f"__carry_{n}" for n in running], *[f"__k{i}" for i in range(len(keys))])
    return out.drop(_SEGMENT)


def latest_rows(
    df: DataFrame, keys: list[str], order: list[str], n: int = 1, newest: bool = True
) -> DataFrame:
    """The n newest (or oldest) rows per key; each map task forwards at most n per key."""
    direction = F.desc if newest else F.asc
    window = Window.partitionBy(*keys).orderBy(*[direction(c) for c in order])
    return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") <= n).drop("__rn")


CROWDED_FRAME_ROWS = 1_000_000


def edge_frame_rows(
    df: DataFrame,
    keys: list[str],
    frame: str,
    which: str,
    ticks: int = 1,
    crowd: int = CROWDED_FRAME_ROWS,
) -> DataFrame:
    """Rows whose frame is among the first or last `ticks` ticks of their group.

    Ranking cuts each map task's rows to that many distinct frames before the shuffle; the
    tick test then settles gaps. When a single frame is beyond `crowd` rows, the edge tick is
    aggregated first and joined, and AQE splits the crowded frame over tasks.
    """
    if which not in ("first", "last"):
        raise ValueError(f"frame policy must be 'first' or 'last', got {which!r}")
    first = which == "first"
    known = df.dropna(subset=[*keys, frame])
    edge = (F.min if first else F.max)(frame)
    if split_large_groups(known, [*keys, frame], crowd)[1] is not None:
        edges = known.groupBy(*keys).agg(edge.alias("__edge"))
        near = known.join(edges, keys)
    else:
        group = Window.partitionBy(*keys)
        ranked = group.orderBy(F.asc(frame) if first else F.desc(frame))
        near = known.withColumn("__rank", F.dense_rank().over(ranked))
        near = near.where(F.col("__rank") <= ticks).drop("__rank")
        near = near.withColumn("__edge", edge.over(group))
    distance = F.col(frame) - F.col("__edge")
    return near.where(F.abs(distance) < ticks).drop("__edge")


def dense_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """Number rows 0..n-1 in the given order without gathering them in one task.

    The sorted rows are checkpointed, so partition sizes and rows agree; the offsets
    then hold one row per partition.
    """
    fixed = checkpointed(df.orderBy(*order)).select(
        "*",
        F.spark_partition_id().alias("__part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__pos"),
    )
    sizes = fixed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    numbered = fixed.join(F.broadcast(offsets), "__part")  # one row per partition
    return numbered.withColumn(name, F.col("__offset") + F.col("__pos")).drop(
        "__part", "__pos", "__offset"
    )
