"""Frame-level geometry: formation shape, nearest players, coverage, play score.

Players of one frame meet inside the task that holds the frame, so player pairs never
become rows. A frame with more members than MAX_MEMBERS is cut into blocks that meet one
by one; the partial results merge to the same values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmotion.functions import scalars as S
from gridmotion.operators.skew import GROUP_ROWS, split_large_groups
from gridmotion.schemas import FRAME_KEYS, OFFENSE, TARGETED_RECEIVER

MAX_MEMBERS = 256
_MEMBERS = "__members"


def _all_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


# ---------------------------------------------------------------- formation shape


def _shape_values(x: str, y: str) -> dict[str, Column]:
    return {
        "formation_width": F.max(y) - F.min(y),
        "formation_depth": F.max(x) - F.min(x),
        "formation_x_mean": F.avg(x),
        "formation_y_mean": F.avg(y),
    }


def _relative_to_shape(df: DataFrame, x: str, y: str) -> DataFrame:
    df = df.withColumns(
        {
            "relative_formation_depth": F.col(x) - F.col("formation_x_mean"),
            "relative_formation_width": F.col(y) - F.col("formation_y_mean"),
        }
    )
    return df.withColumn(
        "distance_to_formation_center",
        S.euclidean(F.col("relative_formation_depth"), F.col("relative_formation_width")),
    )


def _shape_by_window(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    window = Window.partitionBy(*keys)
    shape = {
        "formation_width": F.max(y).over(window) - F.min(y).over(window),
        "formation_depth": F.max(x).over(window) - F.min(x).over(window),
        "formation_x_mean": F.avg(x).over(window),
        "formation_y_mean": F.avg(y).over(window),
    }
    present = _all_present(keys)
    df = df.withColumns({name: F.when(present, value) for name, value in shape.items()})
    return _relative_to_shape(df, x, y)


def _shape_by_join(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    shape = side_shapes(df, keys[:-1], keys[-1], x, y)
    return _relative_to_shape(df.join(shape, keys, "left"), x, y)


def side_shapes(
    df: DataFrame,
    frame_keys: list[str] = FRAME_KEYS,
    side: str = "player_side",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Width, depth and centre per side and frame."""
    return df.groupBy(*frame_keys, side).agg(
        *[v.alias(n) for n, v in _shape_values(x, y).items()]
    )


def formation_features(
    df: DataFrame,
    frame_keys: list[str] = FRAME_KEYS,
    side: str = "player_side",
    x: str = "x",
    y: str = "y",
    max_members: int = MAX_MEMBERS,
) -> DataFrame:
    """Width, depth and centre of each side in each frame, and each player's offset to it."""
    keys = [*frame_keys, side]
    whole, crowded = split_large_groups(df, keys, max_members)
    out = _shape_by_window(whole, keys, x, y)
    if crowded is None:
        return out
    return out.unionByName(_shape_by_join(crowded.drop(GROUP_ROWS), keys, x, y))


# ---------------------------------------------------------------- coverage


def coverage_columns(radii: tuple[float, ...]) -> list[str]:
    return [
        "distance_to_nearest_teammate",
        "distance_to_nearest_opponent",
        "coverage_density",
        *[f"opponents_within_{int(r)}yds" for r in radii],
        *[f"teammates_within_{int(r)}yds" for r in radii],
    ]


def _member(side: str, pid: str, x: str, y: str) -> Column:
    return F.struct(
        F.col(side).alias("side"),
        F.col(pid).alias("pid"),
        F.col(x).cast("double").alias("x"),
        F.col(y).cast("double").alias("y"),
    )


def _against_members(df: DataFrame, side: str, pid: str, x: str, y: str, radii) -> DataFrame:
    """Summaries of each row against its member array; counts and sums, so they can merge."""

    def distances(test) -> Column:
        chosen = F.filter(_MEMBERS, lambda m: (m["pid"] != F.col(pid)) & test(m["side"]))
        return F.transform(chosen, lambda m: S.euclidean(F.col(x) - m["x"], F.col(y) - m["y"]))

    def within(array: str, radius: float) -> Column:
        return F.size(F.filter(array, lambda d: d < radius)).cast("bigint")

    df = df.withColumns(
        {
            "__opp": distances(lambda other: other != F.col(side)),
            "__tm": distances(lambda other: other == F.col(side)),
        }
    )
    density = F.aggregate(
        "__opp", F.lit(0.0), lambda acc, d: acc + F.coalesce(1.0 / (1.0 + d), F.lit(0.0))
    )
    new = {
        "__others": F.exists(_MEMBERS, lambda m: m["pid"] != F.col(pid)).cast("int"),
        "__n_opp": F.size("__opp"),
        "__n_tm": F.size("__tm"),
        "distance_to_nearest_teammate": F.array_min("__tm"),
        "distance_to_nearest_opponent": F.array_min("__opp"),
        "coverage_density": density,
    }
    for r in radii:
        new[f"opponents_within_{int(r)}yds"] = within("__opp", r)
        new[f"teammates_within_{int(r)}yds"] = within("__tm", r)
    return df.withColumns(new).drop("__opp", "__tm", _MEMBERS)


def _null_without_pairs(df: DataFrame, radii) -> DataFrame:
    """Counts and sums are null, not 0, for a player who met nobody of that kind."""
    new = {"coverage_density": F.when(F.col("__others") > 0, F.col("coverage_density"))}
    for r in radii:
        for label, seen in (("opponents", "__n_opp"), ("teammates", "__n_tm")):
            name = f"{label}_within_{int(r)}yds"
            new[name] = F.when(F.col(seen) > 0, F.col(name))
    return df.withColumns(new).drop("__others", "__n_opp", "__n_tm")


def _rows_with_blocks(df, frame_keys, side, pid, x, y, max_members) -> DataFrame:
    """Each row once per block of its frame, with that block's members."""
    blocks = F.ceil(F.col(GROUP_ROWS) / F.lit(max_members)).cast("int")
    slim = df.where(F.col(pid).isNotNull()).select(
        *frame_keys, side, pid, x, y, blocks.alias("__blocks")
    )
    block_of = F.pmod(F.xxhash64(pid), F.col("__blocks")).cast("int")
    members = (
        slim.withColumn("__block", block_of)
        .groupBy(*frame_keys, "__block")
        .agg(F.collect_list(_member(side, pid, x, y)).alias(_MEMBERS))
    )
    each = slim.withColumn("__block", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return each.join(members, [*frame_keys, "__block"]).drop("__blocks", "__block")


def _rows_with_frame(df, frame_keys, side, pid, x, y) -> DataFrame:
    """Each row with all members of its frame."""
    present = _all_present([*frame_keys, pid])
    members = F.collect_list(F.when(present, _member(side, pid, x, y)))
    return df.withColumn(_MEMBERS, members.over(Window.partitionBy(*frame_keys)))


def frame_neighbours(
    df: DataFrame,
    frame_keys: list[str] = FRAME_KEYS,
    side: str = "player_side",
    pid: str = "nfl_id",
    x: str = "x",
    y: str = "y",
    max_members: int = MAX_MEMBERS,
) -> DataFrame:
    """Every other player of the frame, per player, as an array of (pid, same_side, distance).

    A player of a crowded frame has one row per block, each with a bounded array.
    """
    slim = df.where(_all_present([*frame_keys, pid])).select(*frame_keys, side, pid, x, y)
    whole, crowded = split_large_groups(slim, frame_keys, max_members)
    met = _rows_with_frame(whole, frame_keys, side, pid, x, y)
    if crowded is not None:
        met = met.unionByName(
            _rows_with_blocks(crowded, frame_keys, side, pid, x, y, max_members)
        )
    neighbours = F.transform(
        F.filter(_MEMBERS, lambda m: m["pid"] != F.col(pid)),
        lambda m: F.struct(
            m["pid"].alias("pid"),
            (m["side"] == F.col(side)).alias("same_side"),
            S.euclidean(F.col(x) - m["x"], F.col(y) - m["y"]).alias("distance"),
        ),
    )
    return met.select(*frame_keys, side, pid, neighbours.alias("neighbours"))


def _frame_starts(table: pa.Table, frame_keys: list[str]) -> np.ndarray:
    """Positions where a frame begins; a row with a missing key is a frame of its own."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for key in frame_keys:
        column = table.column(key).combine_chunks()
        changed = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)), True)
        new[1:] |= changed.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values get equal codes, missing ones -1."""
    codes = column.combine_chunks().dictionary_encode().indices
    return pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)


def _nearest(candidates: np.ndarray, with_nan: bool) -> np.ndarray:
    """Smallest distance per row; infinity stands for nobody, NaN counts only alone."""
    if not with_nan:
        return candidates.min(axis=2)
    smallest = np.fmin.reduce(candidates, axis=2)
    only_nan = np.isinf(smallest) & np.isnan(candidates).any(axis=2)
    return np.where(only_nan, np.nan, smallest)


def _frame_coverage(table: pa.Table, frame_keys, side, pid, x, y, radii) -> pa.Table:
    starts = _frame_starts(table, frame_keys)
    sizes = np.diff(np.append(starts, table.num_rows))
    xs, ys = (table.column(c).to_numpy().astype(np.float64) for c in (x, y))
    placed = ~(
        table.column(x).is_null().to_numpy() | table.column(y).is_null().to_numpy()
    )
    ids, sides = _codes(table.column(pid)), _codes(table.column(side))
    # Usual data has no gaps; the masks for missing values are then left out.
    all_placed, all_known, all_sided = placed.all(), (ids >= 0).all(), (sides >= 0).all()
    with_nan = not (np.isfinite(xs).all() and np.isfinite(ys).all())
    names = coverage_columns(radii)
    values = {name: np.zeros(table.num_rows) for name in names}
    absent = {name: np.ones(table.num_rows, dtype=bool) for name in names}
    for size in np.unique(sizes):
        at = starts[sizes == size][:, None] + np.arange(size)

        def pairwise(test, values, at=at):
            return test(values[at][:, :, None], values[at][:, None, :])

        dx, dy = pairwise(np.subtract, xs), pairwise(np.subtract, ys)
        distance = np.sqrt(dx * dx + dy * dy)
        others = pairwise(np.not_equal, ids)
        if not all_known:
            others &= pairwise(np.logical_and, ids >= 0)
        same = pairwise(np.equal, sides)
        mates, rivals = others & same, others & ~same
        if not all_sided:
            sided = pairwise(np.logical_and, sides >= 0)
            mates, rivals = mates & sided, rivals & sided
        both_placed = None if all_placed else pairwise(np.logical_and, placed)
        absent["coverage_density"][at] = ~others.any(axis=2)
        own = pairwise(np.equal, ids) & (ids[at] >= 0)[:, :, None] | np.eye(size, dtype=bool)
        for label, met in (("teammate", mates), ("opponent", rivals)):
            usable = met if both_placed is None else met & both_placed
            candidates = np.where(usable, distance, np.inf)
            if label == "opponent":
                values["coverage_density"][at] = (1.0 / (1.0 + candidates)).sum(axis=2)
            alone = ~met.any(axis=2)
            nearest = f"distance_to_nearest_{label}"
            values[nearest][at] = _nearest(candidates, with_nan)
            absent[nearest][at] = alone if usable is met else ~usable.any(axis=2)
            for r in radii:
                name = f"{label}s_within_{int(r)}yds"
                values[name][at] = (candidates < r).sum(axis=2)
                absent[name][at] = alone
        if own.sum() > at.size:  # rows that share a key add up, as they do across blocks
            for name in names:
                each = np.broadcast_to(values[name][at][:, None, :], own.shape)
                gone = absent[name][at]
                if "nearest" in name:
                    met = np.where(own & ~gone[:, None, :], each, np.inf)
                    values[name][at] = _nearest(met, with_nan)
                else:
                    values[name][at] = np.where(own, each, 0).sum(axis=2)
                absent[name][at] = ~(own & ~gone[:, None, :]).any(axis=2)
    for name in names:
        column = values[name].astype(np.int64) if "_within_" in name else values[name]
        table = table.append_column(name, pa.array(column, mask=absent[name]))
    return table


def _coverage_by_frame(df, frame_keys, side, pid, x, y, radii) -> DataFrame:
    """Coverage with whole frames inside a task: rows arrive frame by frame, batch by batch."""
    integer = {name for name in coverage_columns(radii) if "_within_" in name}
    fields = [
        T.StructField(name, T.LongType() if name in integer else T.DoubleType())
        for name in coverage_columns(radii)
    ]
    schema = T.StructType([*df.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last frame of a batch may go on in the next one
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if table.num_rows == 0:
                continue
            cut = int(_frame_starts(table, frame_keys)[-1])
            held = table.slice(cut)
            if cut:
                done = _frame_coverage(
                    table.slice(0, cut), frame_keys, side, pid, x, y, radii
                )
                yield from done.to_batches()
        if held is not None and held.num_rows:
            yield from _frame_coverage(held, frame_keys, side, pid, x, y, radii).to_batches()

    return df.sortWithinPartitions(*frame_keys).mapInArrow(run, schema)


def _coverage_by_blocks(df, frame_keys, side, pid, x, y, radii, max_members) -> DataFrame:
    met = _rows_with_blocks(df, frame_keys, side, pid, x, y, max_members)
    partial = _against_members(met, side, pid, x, y, radii)
    nearest = ["distance_to_nearest_teammate", "distance_to_nearest_opponent"]
    summed = [c for c in coverage_columns(radii) if c not in nearest]
    keys = [*frame_keys, pid]
    merged = partial.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in nearest],
        *[F.sum(c).alias(c) for c in [*summed, "__others", "__n_opp", "__n_tm"]],
    )
    return df.drop(GROUP_ROWS).join(_null_without_pairs(merged, radii), keys, "left")


def coverage_features(
    df: DataFrame,
    radii: tuple[float, ...] = (3.0, 5.0, 7.0),
    frame_keys: list[str] = FRAME_KEYS,
    side: str = "player_side",
    pid: str = "nfl_id",
    x: str = "x",
    y: str = "y",
    max_members: int = MAX_MEMBERS,
) -> DataFrame:
    """Nearest teammate and opponent, opponents' sum of 1/(1+d), players closer than each radius."""
    whole, crowded = split_large_groups(df, frame_keys, max_members)
    whole = whole.repartition(*[F.col(k) for k in frame_keys])
    out = _coverage_by_frame(whole, frame_keys, side, pid, x, y, radii)
    if crowded is None:
        return out
    blocked = _coverage_by_blocks(crowded, frame_keys, side, pid, x, y, radii, max_members)
    return out.unionByName(blocked)


def shape_and_coverage(
    df: DataFrame,
    radii: tuple[float, ...],
    frame_keys: list[str],
    side: str,
    pid: str,
    x: str,
    y: str,
    max_members: int = MAX_MEMBERS,
) -> DataFrame:
    """formation_features and coverage_features on one shuffle by frame."""
    whole, crowded = split_large_groups(df, frame_keys, max_members)
    keys = [*frame_keys, side]
    whole = whole.repartition(*[F.col(k) for k in frame_keys])
    out = _coverage_by_frame(
        _shape_by_window(whole, keys, x, y), frame_keys, side, pid, x, y, radii
    )
    if crowded is None:
        return out
    size = crowded.select(*frame_keys, GROUP_ROWS).distinct()
    shaped = _shape_by_join(crowded.drop(GROUP_ROWS), keys, x, y).join(size, frame_keys, "left")
    blocked = _coverage_by_blocks(shaped, frame_keys, side, pid, x, y, radii, max_members)
    return out.unionByName(blocked)


# ---------------------------------------------------------------- frame summaries


def team_opponent_means(
    df: DataFrame,
    frame_keys: list[str] = FRAME_KEYS,
    side: str = "player_side",
    x: str = "x_norm",
    y: str = "y_norm",
) -> DataFrame:
    """Mean position of each player's own team (self included) and of everyone else.

    Only two small sums per side cross the network; NaN stands for an empty team.
    """
    known = F.col(x).isNotNull() & F.col(y).isNotNull()
    sums = {"n": F.lit(1), "x": F.col(x), "y": F.col(y)}
    teams = df.groupBy(*frame_keys, side).agg(
        *[
            F.coalesce(F.sum(F.when(known, v)), F.lit(0)).cast("double").alias(f"__team_{k}")
            for k, v in sums.items()
        ]
    )
    frame = Window.partitionBy(*frame_keys)
    teams = teams.withColumns(
        {f"__opp_{k}": F.sum(f"__team_{k}").over(frame) - F.col(f"__team_{k}") for k in sums}
    )
    same = reduce(
        lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in [*frame_keys, side]]
    )
    joined = df.alias("r").join(teams.alias("t"), same, "left")

    def mean(who: str, axis: str) -> Column:
        total, count = F.col(f"t.__{who}_{axis}"), F.col(f"t.__{who}_n")
        return F.when(count > 0, total / count).otherwise(F.lit(float("nan")))

    return joined.select(
        *[F.col(f"r.{c}").alias(c) for c in df.columns],
        mean("team", "x").alias("team_avg_x"),
        mean("team", "y").alias("team_avg_y"),
        mean("opp", "x").alias("opp_avg_x"),
        mean("opp", "y").alias("opp_avg_y"),
    )


# Contact distance, weight of the targeted receiver, cost of one contact.
CONTACT_DISTANCE = 2.0
RECEIVER_WEIGHT = 50.0
CONTACT_COST = 100.0


def play_state_score(
    df: DataFrame,
    frame_keys: list[str] = FRAME_KEYS,
    contact: float = CONTACT_DISTANCE,
    receiver_weight: float = RECEIVER_WEIGHT,
    contact_cost: float = CONTACT_COST,
) -> DataFrame:
    """Score per frame: the offence near the landing point raises it, defenders in contact lower it."""
    offence = F.coalesce(F.col("player_side") == OFFENSE, F.lit(False))
    receiver = F.coalesce(F.col("player_role") == TARGETED_RECEIVER, F.lit(False))
    slim = df.select(
        *frame_keys,
        "nfl_id",
        "x",
        "y",
        offence.alias("__offence"),
        F.when(receiver, receiver_weight).otherwise(1.0).alias("__weight"),
        S.euclidean(F.col("x") - F.col("ball_land_x"), F.col("y") - F.col("ball_land_y")).alias(
            "__to_ball"
        ),
    )
    near = coverage_features(slim, (contact,), frame_keys, side="__offence")
    touching = f"opponents_within_{int(contact)}yds"
    is_offence = F.col("__offence")
    return near.groupBy(*frame_keys).agg(
        (
            F.coalesce(
                F.sum(F.when(is_offence, -F.col("__weight") * F.col("__to_ball"))), F.lit(0.0)
            )
            - contact_cost * F.coalesce(F.sum(F.when(is_offence, F.col(touching))), F.lit(0))
        ).alias("score")
    )
