"""Scoring texts with a hidden Markov language model.

Words are dealt into a fixed number of classes by a hash; the end of a text has a class of its
own. Latent states emit classes, and a class emits its words by their training counts plus one,
one further share standing for words never seen. Which word of a class comes does not depend
on the state, so Baum-Welch needs the class sequences alone: every pass over the training
texts gives expected counts per task, which are added up across tasks into a model of bounded
size. A text's probability is the scaled forward recursion over its classes times the shares of
its words.

Texts are split into words once, in blocks. A block asks for the corpus counts of its distinct
words, so the exchange holds a row for each block and word, however often it occurs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.llm.common import slices, stored

STATES = 8
CLASSES = 4096
PASSES = 5
SEGMENT = 512  # training takes texts in parts of so many tokens; scoring takes them whole
BLOCK_BYTES = 32_000_000
HELD_OUT = (7, 2)  # texts whose crc32 of the id leaves this remainder are not learnt from
BATCH_TOKENS = 250_000  # that a task runs the model over at once, some 50 MB


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


def initial(class_counts: np.ndarray, states: int = STATES, seed: int = 0) -> Model:
    """Sticky states that tilt the overall class shares, each in its own way."""
    rng = np.random.default_rng(seed)
    share = class_counts + 0.5
    emit = share[:, None] * np.exp(rng.normal(0, 1, (len(share), states)))
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * 0.8
    return Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def refit(model: Model, counts: dict[str, np.ndarray], class_counts: np.ndarray) -> Model:
    """Model from expected counts, lightly smoothed towards the overall shares."""
    start = counts["start"] + 1
    move = counts["move"] + 1
    share = (class_counts + 0.5) / (class_counts + 0.5).sum()
    emit = counts["emit"] + share[:, None] * 10
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _by_step(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by falling length, number of running sequences at each step, classes step by step)."""
    length = np.fromiter(map(len, sequences), np.int64, len(sequences))
    order = np.argsort(-length, kind="stable")
    length = length[order]
    running = np.searchsorted(-length, -np.arange(length[0]), "left") if len(length) else np.zeros(0, np.int64)
    first = np.cumsum(running) - running
    flat = np.concatenate([sequences[i] for i in order]).astype(np.int64)
    row = np.repeat(np.arange(len(length)), length)
    step = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
    by_step = np.empty_like(flat)
    by_step[first[step] + row] = flat
    return order, running, by_step


def forward(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of each class sequence (all of one token at least)."""
    out = np.zeros(len(sequences))
    if not sequences:
        return out
    order, running, classes = _by_step(sequences)
    alpha, at = np.tile(model.start, (len(sequences), 1)), 0
    total = np.zeros(len(sequences))
    for t, n in enumerate(running.tolist()):
        alpha = alpha[:n] @ model.move if t else alpha[:n]
        alpha *= model.emit[classes[at : at + n]]
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        total[:n] += np.log(scale)
        at += n
    out[order] = total
    return out


def expected(model: Model, sequences: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Baum-Welch counts of some class sequences."""
    states, counts = len(model.start), {}
    _, running, classes = _by_step(sequences)
    first = np.cumsum(running) - running
    emit = model.emit[classes]
    alpha, scale = np.empty_like(emit), np.empty(len(classes))
    steps = list(zip(first.tolist(), running.tolist()))
    for t, (at, n) in enumerate(steps):
        a = (alpha[steps[t - 1][0] :][:n] @ model.move if t else model.start) * emit[at : at + n]
        scale[at : at + n] = s = a.sum(1)
        alpha[at : at + n] = a / s[:, None]
    emit /= scale[:, None]
    ahead, move = None, np.zeros((states, states))
    log = float(np.log(scale).sum())
    for t in range(len(steps) - 1, -1, -1):
        at, n = steps[t]
        beta = np.ones((n, states))
        if ahead is not None:
            move += alpha[at : at + len(ahead)].T @ ahead
            beta[: len(ahead)] = ahead @ model.move.T
        if t == 0:
            counts["start"] = (alpha[:n] * beta).sum(0)
        ahead = emit[at : at + n] * beta
        emit[at : at + n] = beta  # from here on the backward values
    alpha *= emit
    size = len(model.emit)
    counts["emit"] = np.stack([np.bincount(classes, alpha[:, k], size) for k in range(states)], axis=1)
    counts["move"] = move * model.move
    counts["log"] = np.array([log])
    return counts


TOKENS = (
    "block long, doc_id long, held_out boolean, low binary, high binary, classes binary,"
    " word binary, local int, class int, seen long"
)


def class_of(word: bytes, classes: int) -> int:
    return 1 + zlib.crc32(word) % (classes - 1) if word else 0


def tokenize(docs: DataFrame, classes: int = CLASSES) -> DataFrame:
    """Texts as word numbers of their block, and each block's words; stored once.

    A row is either a text (its word numbers as a 16-bit and an 8-bit plane, its classes) or a
    word of a block (its number, class and count in texts learnt from). The end of a text is
    the empty word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 28
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                held = part.column("held_out").to_pylist()
                numbers: dict[bytes, int] = {b"": 0}
                rows = []
                for text in texts:
                    tokens = (text or b"").lower().split()
                    tokens.append(b"")
                    rows.append(np.array([numbers.setdefault(w, len(numbers)) for w in tokens], np.int32))
                names = list(numbers)
                seen = np.zeros(len(names), np.int64)
                uses = np.zeros(len(names), np.int64)
                for row, out in zip(rows, held):
                    np.add.at(uses, row, 1)
                    if not out:
                        np.add.at(seen, row, 1)
                # Frequent words get small numbers, so the upper plane is mostly zero.
                order = np.argsort(-uses, kind="stable")
                number = np.empty(len(order), np.int32)
                number[order] = np.arange(len(order), dtype=np.int32)
                kind = np.array([class_of(w, classes) for w in names], np.uint16)
                n, m = len(rows), len(names)
                kinds = pa.array([kind[r].astype("<u2").tobytes() for r in rows], pa.binary())
                for i, row in enumerate(rows):
                    rows[i] = number[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, block)),
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array([(r & 0xFFFF).astype("<u2").tobytes() for r in rows], pa.binary()),
                        pa.array([(r >> 16).astype("u1").tobytes() for r in rows], pa.binary()),
                        kinds,
                        pa.nulls(n, pa.binary()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.int64()),
                    ],
                    [f.split()[0] for f in TOKENS.split(", ")],
                )
                for at in range(0, m, 50_000):
                    cut = slice(at, min(m, at + 50_000))
                    k = cut.stop - at
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(k, block)),
                            pa.nulls(k, pa.int64()),
                            pa.nulls(k, pa.bool_()),
                            pa.nulls(k, pa.binary()),
                            pa.nulls(k, pa.binary()),
                            pa.nulls(k, pa.binary()),
                            pa.array(names[cut], pa.binary()),
                            pa.array(number[cut].astype(np.int32)),
                            pa.array(kind[cut].astype(np.int32)),
                            pa.array(seen[cut]),
                        ],
                        [f.split()[0] for f in TOKENS.split(", ")],
                    )
                block += 1

    rest, which = HELD_OUT
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % rest == which).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return stored(rows.mapInArrow(run, TOKENS), "tokens")


def _summed(parts: DataFrame, folds: int) -> DataFrame:
    """Add up expected counts (one row a task) in `folds` tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, raw in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist()):
                value = np.frombuffer(raw)
                total[name] = total[name] + value if name in total else value.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            ["name", "value"],
        )

    return parts.repartition(folds).mapInArrow(run, "name string, value binary")


def one_pass(model: Model, texts: DataFrame) -> dict[str, np.ndarray]:
    """Expected counts over all training texts: summed in tasks, then across them by a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        waiting, size = [], 0

        def settle():
            nonlocal waiting, size
            for name, value in expected(model, waiting).items() if waiting else ():
                total[name] = total[name] + value if name in total else value
            waiting, size = [], 0

        for batch in batches:
            for raw in batch.column("classes").to_pylist():
                row = np.frombuffer(raw, "<u2")
                for at in range(0, len(row), SEGMENT):
                    waiting.append(row[at : at + SEGMENT])
                    size += len(waiting[-1])
                    if size >= BATCH_TOKENS:
                        settle()
        settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            ["name", "value"],
        )

    parts = texts.mapInArrow(run, "name string, value binary")
    folds = max(1, int(texts.sparkSession.sparkContext.defaultParallelism ** 0.5))
    out: dict[str, np.ndarray] = {}
    for row in _summed(parts, folds).collect():  # a model's size from each of a few tasks
        value = np.frombuffer(row["value"])
        out[row["name"]] = out[row["name"]] + value if row["name"] in out else value.copy()
    states = len(model.start)
    if not out:
        return {"start": np.zeros(states), "move": np.zeros((states, states)), "emit": np.zeros_like(model.emit)}
    out["move"] = out["move"].reshape(states, states)
    out["emit"] = out["emit"].reshape(-1, states)
    return out


def whole_texts(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most so many tokens together, or one text."""
    done, at = np.cumsum(lengths), 0
    while at < len(lengths):
        end = max(at + 1, int(np.searchsorted(done, done[at] - lengths[at] + most, "right")))
        yield at, end
        at = end


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SCORE_KINDS = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]


def score_documents(
    docs: DataFrame, states: int = STATES, classes: int = CLASSES, passes: int = PASSES
) -> DataFrame:
    """Score every row of docs (doc_id, text) with a model of the texts not held out.

    Null text is empty: its only token is the end. A null doc_id counts as the empty text in
    the hold-out rule. Repeated rows are learnt from and scored each; other columns are
    ignored; an empty table gives an empty result, and where nothing is learnt from every
    word counts as unseen.
    """
    tokens = tokenize(docs, classes)
    asked = tokens.where("word IS NOT NULL").select("block", "word", "local", "class", "seen")
    known = stored(
        asked.withColumn("c", F.sum("seen").over(Window.partitionBy("word"))).select(
            "block", "local", "class", "c",
            (F.row_number().over(Window.partitionBy("word").orderBy("block")) == 1).alias("first"),
        ),
        "word-counts",
    )
    sums = (
        known.where("first").groupBy("class").agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"))
    ).collect()  # one row a class
    mass, kinds = np.zeros(classes), np.zeros(classes)
    for r in sums:
        mass[r["class"]], kinds[r["class"]] = r["n"], r["v"]
    total, distinct = int(mass.sum()), int(kinds.sum())
    model = initial(mass, states)
    texts = tokens.where("classes IS NOT NULL")
    learning = texts.where("NOT held_out").select("classes")
    for _ in range(passes):
        model = refit(model, one_pass(model, learning), mass)

    names = [f.split()[0] for f in SCORES.split(", ")]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        local = right.column("local").to_numpy()
        count, kind = np.zeros(len(local), np.int64), np.zeros(len(local), np.int64)
        count[local], kind[local] = right.column("c").to_numpy(), right.column("class").to_numpy()
        base = np.log10((count + 1) / (total + distinct + 1))
        share = np.log10((count + 1) / (mass[kind] + kinds[kind] + 1))
        n = pc.binary_length(left.column("high")).to_numpy().astype(np.int64)  # a byte a token
        parts = []
        for at, end in whole_texts(n, BATCH_TOKENS):
            part = left.slice(at, end - at)
            rows = []
            for low, high in zip(part.column("low").to_pylist(), part.column("high").to_pylist()):
                rows.append(np.frombuffer(low, "<u2").astype(np.int32) | np.frombuffer(high, "u1").astype(np.int32) << 16)
            flat = np.concatenate(rows)
            begin = np.cumsum(n[at:end]) - n[at:end]
            adds = lambda values: np.add.reduceat(values, begin)  # noqa: B023, E731
            latent = forward(model, [kind[r] for r in rows]) / np.log(10)
            parts.append(
                pa.table(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(n[at:end]),
                        pa.array(adds((count[flat] > 0).astype(np.int64))),
                        pa.array(np.full(end - at, total)),
                        pa.array(adds(base[flat])),
                        pa.array(latent + adds(share[flat])),
                    ],
                    names,
                )
            )
        return pa.concat_tables(parts) if parts else pa.schema(zip(names, SCORE_KINDS)).empty_table()

    wanted = texts.select("block", "doc_id", "held_out", "low", "high")
    return wanted.groupBy("block").cogroup(known.select("block", "local", "class", "c").groupBy("block")).applyInArrow(score, SCORES)
