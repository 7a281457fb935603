"""Grading documents by ordinal regression on hashed text.

A document's grade is 0 (toxic), 1 (poor) or 2 (good). The model is a cumulative-link one:
P(grade >= j) = logistic(w.x - c_j) with one weight vector for all grades and ordered
thresholds. Features are the distinct words and the shape of the text, hashed to 32 bits.
All labelled documents are learnt from. Gradients of the likelihood are summed over partitions,
the model's numbers (one a telling feature) stay on the driver, and scoring is one pass over the
texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmotion.llm.common import fresh_folder, open_store, removed, slices, stored

LEAST_TEXTS = 3  # features of fewer training texts have no weight
LEAST_CHI2 = 15.0  # nor have those whose texts are graded much like all texts
STEPS = 60
PENALTY = 2e-5
GRADES = 3
KEEP_FROM = 0.5  # least probability of the top grade
GRADES_BYTES = 4_000_000  # ids and grades of labelled documents a task holds at once
COUNTED_AT_ONCE = 4_000_000  # features of documents a task counts before it hands their counts on

STRIP = b".,;:!?\"'()[]{}|*#%$&@"
DIGITS, UPPER, SPACE = b"0123456789", bytes(range(65, 91)), b" \t\n\r\x0b\x0c"
LETTERS = UPPER + UPPER.lower() + bytes(range(128, 256))
MARKS = bytes(set(range(128)) - set(LETTERS + DIGITS + SPACE + b"_"))
SYMBOLS = b"#%$&*|!"
ONLY_MARKS, ONLY_SYMBOLS = (bytes(b if b in kept else 32 for b in range(256)) for kept in (MARKS, SYMBOLS))
WORD, MARK = zlib.crc32(b"w:"), zlib.crc32(b"m:")
STEPS_OF = {
    name: [zlib.crc32(f"s:{name}>{k}".encode()) for k in range(20)]
    for name in ("distinct", "commonest", "upper", "marks", "digits", "lines", "symbols")
}
LENGTHS = [zlib.crc32(f"s:length>{n}".encode()) for n in range(21)]


def features(raw: bytes) -> list[int]:
    """Hashed features of a UTF-8 text: distinct words, and its shape in coarse steps."""
    times = Counter(raw.split())
    n = times.total()
    lowered = {t.strip(STRIP) for t in set(raw.lower().split())}
    lowered.discard(b"")
    out = {zlib.crc32(w, WORD) for w in lowered}
    for run in set(raw.translate(ONLY_MARKS).split()):  # in parts of four marks, a last one of two at least
        out.update(zlib.crc32(run[i : i + 4], MARK) for i in range(0, len(run) - 1, 4))
    total, size = max(1, n), max(1, len(raw))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    among = lambda kept: len(raw) - len(raw.translate(None, kept))
    shape = {
        "distinct": len(times) / total,
        "commonest": max(times.values(), default=0) / total,
        "upper": among(UPPER) / max(1, among(LETTERS)),
        "marks": among(MARKS) / size,
        "digits": among(DIGITS) / size,
        "lines": len(set(lines)) / max(1, len(lines)),
        "symbols": sum(len(run) > 1 for run in raw.translate(ONLY_SYMBOLS).split()) / total,
    }
    for name, value in shape.items():
        out.update(STEPS_OF[name][: math.ceil(min(value, 1) * 20)])
    out.add(LENGTHS[min(20, n.bit_length())])
    return sorted(out)


@dataclass
class Model:
    ids: np.ndarray  # hashed features with a weight, ascending
    weights: np.ndarray
    cuts: np.ndarray  # ascending thresholds

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1.. of scores x."""
        return 1 / (1 + np.exp(-np.clip(x[:, None] - self.cuts, -40, 40)))


def _likelihood(x: np.ndarray, grade: np.ndarray, cuts: np.ndarray):
    """(loss, d loss / d x, d loss / d cuts) of the cumulative-link model."""
    upper = 1 / (1 + np.exp(-np.clip(x[:, None] - np.r_[-np.inf, cuts, np.inf], -40, 40)))
    upper[:, 0], upper[:, -1] = 1, 0
    rows = np.arange(len(x))
    a, b = upper[rows, grade], upper[rows, grade + 1]
    p = np.maximum(a - b, 1e-12)
    slope = upper * (1 - upper)
    da, db = slope[rows, grade] / p, slope[rows, grade + 1] / p
    by_cut = np.zeros(len(cuts) + 2)
    np.add.at(by_cut, grade, da)
    np.add.at(by_cut, grade + 1, -db)
    return -np.log(p).sum(), -(da - db), by_cut[1:-1]


def _minimise(value, start: np.ndarray, steps: int) -> np.ndarray:
    """Limited-memory quasi-Newton descent; `value` gives (loss, gradient)."""
    at, (loss, slope), past = start, value(start), []
    for _ in range(steps):
        way = -slope
        alphas = []
        for s, y in reversed(past):
            alphas.append(s @ way / (s @ y))
            way = way - alphas[-1] * y
        if past:
            s, y = past[-1]
            way = way * (s @ y / (y @ y))
        for (s, y), alpha in zip(past, reversed(alphas)):
            way = way + (alpha - y @ way / (s @ y)) * s
        if not past:
            way = way / max(1.0, np.linalg.norm(way))
        reach = 1.0
        for _ in range(12):
            there = at + reach * way
            new_loss, new_slope = value(there)
            if new_loss <= loss + 1e-4 * reach * (way @ slope):
                break
            reach /= 2
        else:
            break
        step, change = there - at, new_slope - slope
        if step @ change > 1e-12:
            past = [*past[-7:], (step, change)]
        done = loss - new_loss < 1e-5 * abs(loss)
        at, loss, slope = there, new_loss, new_slope
        if done:
            break
    return at


def _grade_reader(path: str) -> Callable[[np.ndarray], np.ndarray]:
    """Grades of documents by their ids, -1 without one, from files in the order of the ids: no text travels to meet its label."""
    store, base = open_store(path)
    groups, last = [], (None, None)
    for name in sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet")):
        with store.open_input_file(name) as opened:
            told = pq.ParquetFile(opened).metadata
            within = [told.row_group(i).column(0).statistics for i in range(told.num_row_groups)]
            groups += [(name, i, s.min, s.max) for i, s in enumerate(within)]

    def grade_of(ids: np.ndarray) -> np.ndarray:
        nonlocal last
        out = np.full(len(ids), -1, np.int32)
        for name, i, lo, hi in groups:
            mine = np.flatnonzero((ids >= lo) & (ids <= hi))
            if not len(mine):
                continue
            if last[0] != (name, i):
                with store.open_input_file(name) as opened:
                    held = pq.ParquetFile(opened).read_row_group(i, ["__id", "grade"])
                last = ((name, i), (held.column("__id").to_numpy(), held.column("grade").to_numpy()))
            known, grades = last[1]
            at = np.searchsorted(known, ids[mine])  # no id is beyond the last one
            out[mine] = np.where(known[at] == ids[mine], grades[at], -1)
        return out

    return grade_of


def training_rows(docs: DataFrame, labels: DataFrame, bound: int | None = None) -> DataFrame:
    """(grade, hashed features in 32 bits each) of all labelled documents, or of about `bound` chosen by a hash.

    A toxic label grades 0, otherwise poor quality 1 and good quality 2; the lowest of several
    labels counts, and labels with a null are left out.
    """
    graded = labels.select(
        F.col("doc_id").cast("long").alias("__id"),
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"),
    ).where("__id IS NOT NULL AND grade IS NOT NULL")
    graded = graded.groupBy("__id").agg(F.min("grade").alias("grade"))
    if bound is not None and (total := graded.count()) > bound:
        share = int(bound / total * 1_000_000)
        graded = graded.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < share)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = fresh_folder(docs.sparkSession, "grades")
    ordered = graded.repartitionByRange("__id").sortWithinPartitions("__id")
    ordered.write.option("parquet.block.size", GRADES_BYTES).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grade_of = _grade_reader(path)
        for batch in batches:
            grade = grade_of(batch.column("doc_id").to_numpy())
            hit = pa.array(grade >= 0)
            batch = pa.RecordBatch.from_arrays([pa.array(grade, pa.int32()), batch.column("text")], ["grade", "text"]).filter(hit)
            for part in slices(batch, "text"):
                found = [np.array(features(t or b""), "<u4").tobytes() for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("grade"), pa.array(found, pa.binary())], ["grade", "ids"])

    rows = stored(texts.where("doc_id IS NOT NULL").mapInArrow(run, "grade int, ids binary"), "graded")
    removed(docs.sparkSession, path)
    return rows


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of a batch of training rows."""
    raw = batch.column("ids").to_pylist()
    row = np.repeat(np.arange(len(raw)), [len(r) // 4 for r in raw])
    return row, np.frombuffer(b"".join(raw), "<u4").astype(np.int64)


def _times(rows: DataFrame) -> DataFrame:
    """(id, g0, g1, ..): documents of each grade that have a feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[np.ndarray]) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            ids, at = np.unique(keys // GRADES, return_inverse=True)
            sums = np.zeros((GRADES, len(ids)), np.int64)
            sums[keys % GRADES, at] = n
            return pa.RecordBatch.from_arrays([pa.array(ids), *map(pa.array, sums)], ["id", *(f"g{g}" for g in range(GRADES))])

        held, size = [], 0
        for batch in batches:
            row, ids = _flat(batch)
            held.append(ids * GRADES + batch.column("grade").to_numpy()[row])
            size += len(row)
            if size > COUNTED_AT_ONCE:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    grades = [f"g{g}" for g in range(GRADES)]
    found = rows.mapInArrow(run, ", ".join(["id long", *(f"{g} long" for g in grades)]))
    return found.groupBy("id").agg(*[F.sum(g).alias(g) for g in grades])


def _located(rows: DataFrame, ids: np.ndarray) -> DataFrame:
    """Blocks of training rows for the fit: their grades, and (row, number in ids) of the features that have a weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, flat = _flat(batch)
            at = np.minimum(np.searchsorted(ids, flat), max(0, len(ids) - 1))
            known = ids[at] == flat if len(ids) else np.zeros(len(flat), bool)
            columns = [batch.column("grade").to_numpy(), row[known], at[known]]
            yield pa.RecordBatch.from_arrays([pa.array([c.astype("<i4").tobytes()], pa.binary()) for c in columns], ["grade", "row", "at"])

    return stored(rows.mapInArrow(run, "grade binary, row binary, at binary"), "located")


def fit(rows: DataFrame, steps: int = STEPS, penalty: float = PENALTY) -> Model:
    """Cumulative-link regression on stored rows (grade, ids)."""
    shares = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}  # a row a grade
    total = sum(shares.values())
    n = sum((F.col(f"g{g}") for g in range(GRADES)), F.lit(0))
    telling = F.lit(False)
    for g, count in shares.items():
        p = count / total
        beyond = F.col(f"g{g}") - n * p
        telling = telling | (beyond * beyond > LEAST_CHI2 * p * (1 - p) * n)
    kept = _times(rows).where((n >= LEAST_TEXTS) & telling).select("id").toArrow()  # the model: a number a telling feature
    ids = np.sort(kept.column("id").to_numpy())
    cuts = np.arange(GRADES - 1, dtype=float) - (GRADES - 2) / 2
    if not total:
        return Model(ids[:0], np.zeros(0), cuts)
    size = len(ids)

    def value(point: np.ndarray):
        weights, first, gaps = point[:size], point[size], np.exp(point[size + 1 :])
        now = first + np.r_[0.0, np.cumsum(gaps)]  # ordered whatever the numbers are

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, by_weight, by_cut = 0.0, np.zeros(size), np.zeros(len(now))
            for batch in batches:
                for block in batch.to_pylist():
                    grade, row, at = (np.frombuffer(block[c], "<i4") for c in ("grade", "row", "at"))
                    x = np.bincount(row, weights[at], len(grade))
                    part, by_x, cut = _likelihood(x, grade, now)
                    loss, by_cut = loss + part, by_cut + cut
                    by_weight += np.bincount(at, by_x[row], size)
            raw = np.r_[loss, by_weight, by_cut].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["sums"])

        sums = sum(np.frombuffer(r["sums"]) for r in blocks.mapInArrow(run, "sums binary").collect()) / total
        cut = sums[1 + size :]
        after = np.cumsum(cut[::-1])[::-1]
        slope = np.r_[sums[1 : 1 + size] + penalty * weights, after[0], after[1:] * gaps]
        return sums[0] + penalty / 2 * weights @ weights, slope

    blocks = _located(rows, ids)
    blocks = blocks.coalesce(max(1, min(blocks.rdd.getNumPartitions(), blocks.sparkSession.sparkContext.defaultParallelism)))
    best = _minimise(value, np.r_[np.zeros(size), cuts[0], np.zeros(GRADES - 2)], steps)
    gaps = np.exp(best[size + 1 :])
    return Model(ids, best[:size], best[size] + np.r_[0.0, np.cumsum(gaps)])


def grade(docs: DataFrame, model: Model, keep_from: float = KEEP_FROM) -> DataFrame:
    """docs with expected_grade, tail (probability of the top grade) and kept.

    A null text is empty and is graded by the thresholds and its shape; null ids and repeated
    rows are graded like others; columns of docs that bear one of these names are replaced.
    """
    mass = dict(zip(model.ids.tolist(), model.weights.tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                x = np.array([sum(mass.get(f, 0.0) for f in features(t or b"")) for t in texts])
                tails = model.tails(x)
                columns = [*part.columns, pa.array(tails.sum(1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= keep_from)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "expected_grade", "tail", "kept"])

    rows = docs.drop("expected_grade", "tail", "kept").withColumn("text", F.col("text").cast("string"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, expected_grade double, tail double, kept boolean")


def graded_documents(docs: DataFrame, labels: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Fit on the labelled ones among `source` (docs if none) and grade every row of docs."""
    return grade(docs, fit(training_rows(docs if source is None else source, labels)))
