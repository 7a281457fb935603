"""Fixed-length sequences, padded player sets and formation vectors as array columns.

Each operator cuts a group to the kept length with a rank limit, which Spark applies before
the shuffle, and only then gathers it; an array never exceeds the requested length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.functions import scalars as S
from gridmotion.operators.joins import with_player_index
from gridmotion.operators.normalize import ensure_rightward, only_side
from gridmotion.operators.rollups import (
    TARGET_NAMES,
    formation_targets,
    with_formation_targets,
)
from gridmotion.operators.skew import edge_frame_rows
from gridmotion.schemas import SIDE_FRAME_KEYS, SIDE_KEYS, TIMELINE_KEYS, require_columns


def _padding(width: int, missing: Column) -> Column:
    return F.array_repeat(F.array(*[F.lit(0.0)] * width), missing.cast("int"))


def pack_sequences(
    df: DataFrame,
    features: dict[str, list[str]],
    length: int,
    keys: list[str] = TIMELINE_KEYS,
    order: str = "frame_id",
    keep: str = "first",
    pad: str | None = "right",
) -> DataFrame:
    """One row per key: the first or last `length` rows in order, as arrays of feature rows.

    features maps an array column to the columns it holds. Short sequences are filled with
    zero rows on the given side; pad=None leaves short sequences out. n_steps counts the
    real rows kept, steps holds their order values.
    """
    if keep not in ("first", "last") or pad not in ("left", "right", None):
        raise ValueError(f"unsupported keep={keep!r} or pad={pad!r}")
    direction = F.asc if keep == "first" else F.desc
    window = Window.partitionBy(*keys).orderBy(direction(order))
    item = F.struct(
        F.col(order).alias("at"),
        *[
            F.array(*[F.col(c).cast("double") for c in columns]).alias(name)
            for name, columns in features.items()
        ],
    )
    packed = (
        df.dropna(subset=keys)
        .withColumn("__rn", F.row_number().over(window))
        .where(F.col("__rn") <= length)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(item)).alias("__steps"))
    )
    n_steps = F.size("__steps")
    if pad is None:
        packed = packed.where(n_steps == length)

    def filled(name: str, columns: list[str]) -> Column:
        rows = F.transform("__steps", lambda step: step[name])
        zeros = _padding(len(columns), F.lit(length) - n_steps)
        if pad is None:
            return rows
        return F.concat(zeros, rows) if pad == "left" else F.concat(rows, zeros)

    return packed.select(
        *keys,
        n_steps.alias("n_steps"),
        F.transform("__steps", lambda step: step["at"]).alias("steps"),
        *[filled(name, columns).alias(name) for name, columns in features.items()],
    )


def label_sequences(joined: DataFrame, length: int = 100) -> DataFrame:
    """First `length` frames of each predicted player, right-padded: features and scaled labels."""
    scaled = joined.where("player_to_predict")
    x_scaled, y_scaled = S.scale_labels(F.col("x_label"), F.col("y_label"))
    scaled = scaled.withColumns({"x_scaled": x_scaled, "y_scaled": y_scaled})
    return pack_sequences(
        scaled,
        {"features": ["s", "a", "dir", "o"], "labels": ["x_scaled", "y_scaled"]},
        length,
    )


def scaled_sequences(
    df: DataFrame,
    scaler,
    length: int = 15,
    target: list[str] | None = ("tx", "ty"),
    target_scaler=None,
    player_index: DataFrame | None = None,
) -> DataFrame:
    """Last `length` z-scored frames, left-padded with zeros.

    With target columns, sequences without a finite target are left out; target_scaler scales
    them too. player_index adds each player's index, 0 for a player it does not hold.
    """
    out = _scaled(df, scaler, length, target, target_scaler)
    return out if player_index is None else with_player_index(out, player_index, "zero")


def _scaled(df, scaler, length, target, target_scaler) -> DataFrame:
    rows = scaler.transform(df)
    if target is not None and target_scaler is not None:
        rows = target_scaler.transform(rows)
    groups = {"features": list(scaler.means)}
    if target is None:
        return pack_sequences(rows, groups, length, keep="last", pad="left")
    groups["__target"] = list(target)
    return _with_last_target(
        pack_sequences(rows, groups, length, keep="last", pad="left"), len(target)
    )


def _with_last_target(packed: DataFrame, width: int) -> DataFrame:
    """Keep the target of the last frame, and only sequences where all of it is finite."""
    target = F.element_at("__target", -1)
    out = packed.withColumn("target", target).drop("__target")
    for i in range(width):
        out = out.where(S.is_finite(F.col("target")[i]))
    return out


def play_sequences(
    df: DataFrame, features: list[str], targets: list[str] | None = None, length: int = 32
) -> DataFrame:
    """Last `length` frames, left-padded, non-finite features as 0; target of the last frame."""
    rows = df.withColumns({f"__f_{c}": S.zero_if_not_finite(F.col(c)) for c in features})
    groups = {"features": [f"__f_{c}" for c in features]}
    if targets is None:
        return pack_sequences(rows, groups, length, keep="last", pad="left")
    groups["__target"] = targets
    return _with_last_target(
        pack_sequences(rows, groups, length, keep="last", pad="left"), len(targets)
    )


def frame_sequences(
    df: DataFrame, features: list[str], length: int = 32, with_targets: bool = True
) -> DataFrame:
    """Last `length` frames with per-frame targets (x_norm, y_norm); shorter ones are left out."""
    clean = {f"__f_{c}": S.zero_if_not_finite(F.col(c)) for c in features}
    groups = {"features": list(clean)}
    if with_targets:
        for c in ("x_norm", "y_norm"):
            clean[f"__t_{c}"] = S.zero_if_not_finite(F.col(c))
        groups["targets"] = ["__t_x_norm", "__t_y_norm"]
    return pack_sequences(df.withColumns(clean), groups, length, keep="last", pad=None)


def unpack_sequences(
    df: DataFrame, keys: list[str] = TIMELINE_KEYS, steps: str = "steps", values: str = "predictions"
) -> DataFrame:
    """Per-frame rows from per-sequence arrays: frame_id, pred_x, pred_y."""
    zipped = F.arrays_zip(F.col(steps).alias("at"), F.col(values).alias("xy"))
    return df.select(*keys, F.explode(zipped).alias("e")).select(
        *keys,
        F.col("e.at").alias("frame_id"),
        F.col("e.xy")[0].alias("pred_x"),
        F.col("e.xy")[1].alias("pred_y"),
    )


def formation_vectors(
    players: DataFrame,
    side: str | None = "Offense",
    max_players: int = 11,
    frame_policy: str = "first",
    keys: list[str] = SIDE_KEYS,
    x: str = "x_norm",
    y: str = "y_norm",
) -> DataFrame:
    """[x1, y1, x2, y2, ...] of up to max_players players ordered by (y, x), zero-filled.

    n_players counts the players before truncation.
    """
    chosen = edge_frame_rows(only_side(players, side, keys[-1]), keys, "frame_id", frame_policy)
    group = Window.partitionBy(*keys)
    window = group.orderBy(y, x)
    place = F.struct(F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x"))
    vectors = (
        chosen.withColumns(
            {
                "__rn": F.row_number().over(window),
                "__n": F.count(F.lit(1)).over(group),
                "__frame": F.max("frame_id").over(group),
            }
        )
        .where(F.col("__rn") <= max_players)
        .groupBy(*keys)
        .agg(
            F.max("__frame").alias("frame_id"),
            F.max("__n").alias("n_players"),
            F.sort_array(F.collect_list(place)).alias("__places"),
        )
    )
    flat = F.flatten(F.transform("__places", lambda p: F.array(p["x"], p["y"])))
    zeros = F.array_repeat(F.lit(0.0), (F.lit(2 * max_players) - F.size(flat)).cast("int"))
    return vectors.select(
        *keys, "frame_id", "n_players", F.concat(flat, zeros).alias("vector")
    )


def formation_matrix(
    players: DataFrame, side: str | None = None, keys: list[str] = SIDE_KEYS
) -> DataFrame:
    """Five formation features of each side's first frame, as columns and as one vector."""
    require_columns(players, [*keys, "frame_id", "x_norm", "y_norm"], "players table")
    chosen = only_side(players, side, keys[-1]).select(*keys, "frame_id", "x_norm", "y_norm")
    first = edge_frame_rows(chosen, keys, "frame_id", "first")
    targets = formation_targets(first, keys)
    return targets.withColumn("vector", F.array(*TARGET_NAMES))


def player_sets(
    df: DataFrame, n_max: int = 11, keys: list[str] = SIDE_FRAME_KEYS, frame_selector=None
) -> DataFrame:
    """Padded set of up to n_max players per side and frame with mask and formation targets."""
    if frame_selector is not None:
        df = df.transform(frame_selector)
    df = ensure_rightward(df).withColumns(
        {
            "__dir_sin": S.sin_deg(F.col("dir_norm")),
            "__dir_cos": S.cos_deg(F.col("dir_norm")),
            "__o_sin": S.sin_deg(F.col("o_norm")),
            "__o_cos": S.cos_deg(F.col("o_norm")),
        }
    )
    values = ["x_norm", "y_norm", "s", "a", "__dir_sin", "__dir_cos", "__o_sin", "__o_cos"]
    window = Window.partitionBy(*keys).orderBy("x_norm", "y_norm")
    sets = (
        with_formation_targets(df, keys)
        .withColumn("__rn", F.row_number().over(window))
        .where(F.col("__rn") <= n_max)
        .groupBy(*keys)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("__rn", F.array(*[F.col(c).cast("double") for c in values]).alias("f"))
                )
            ).alias("__set"),
            F.first(F.array(*TARGET_NAMES)).alias("targets"),
        )
    )
    missing = F.lit(n_max) - F.size("__set")
    sets = sets.select(
        *keys,
        F.concat(
            F.transform("__set", lambda p: p["f"]), _padding(len(values), missing)
        ).alias("features"),
        F.concat(
            F.array_repeat(F.lit(1.0), F.size("__set")),
            F.array_repeat(F.lit(0.0), missing.cast("int")),
        ).alias("mask"),
        "targets",
    )
    return sets
