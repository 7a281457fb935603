"""Passages that repeat across documents, exactly or nearly, by seeds and collinear chaining.

Seeds are the minimizers of a text's k-word sequences; with a window of 1 every sequence is one.
Only seeds of two or more texts matter, and they are found before any seed is a row: texts lie in
chunks, a chunk tells each range of hashes its distinct ones as differences, and the range
answers with a bit for each. Equal texts are one text here; copies repeat as a whole.

Every occurrence of a repeated seed is linked to its first one (smallest doc_id), that of a rare
seed to its last one too, so links grow with the text and not with the square of a passage's
copies. Where neighbouring seeds have their first occurrences in different places, the longer
sequences across them, up to a whole passage, are linked in the same way, so documents that share
a passage meet even if earlier ones hold all its parts. The links of a pair of documents are
merged along their diagonals into fragments; a Fenwick tree over the fragments' ends finds the
best chains under gap costs. All chains, a single seed too, are aligned and stretched at both
ends, first on short codes of the words; what comes out long and similar enough there is aligned
word by word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmotion.llm.common import fresh_folder, open_store, removed, slices, spent, stored, swept
from gridmotion.operators.skew import dense_index

SEED_WORDS = 5
WINDOW = 1  # of so many consecutive word sequences one is a seed
MIN_WORDS = 50
SIMILARITY = 0.8
GAP_COST = 0.2  # words of score for a word of gap on either side
REACH = 40  # a gap of more words on either side ends a chain
RARE = 6  # a seed of so many occurrences at most is linked to its last one too
PLACE_BITS = 30  # of an occurrence: the number of its text, then its place in words
CHUNK_BYTES = 8_000_000  # text of a chunk
RANGE_BYTES = 12_000_000  # text whose seeds one range of hashes holds, some two million
SHORT_BITS = 48  # of a hash tell seeds apart before they are rows; chance hits are sorted out later
REGION = 2000  # words on either side of the chains that share a row
SLICE_BYTES = 2_000_000  # slices of texts a task hands on, and pairs of them it takes, at once


def word_list(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def minimizers(tokens: list[bytes], k: int = SEED_WORDS, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(positions, 64-bit hashes) of a text's seeds."""
    n = len(tokens) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    single = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    hashed = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + single[j : j + n]
            hashed ^= hashed >> np.uint64(29)
        hashed = (hashed ^ (hashed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(31)
    if window == 1:
        return np.arange(n), hashed
    if n <= window:
        at = np.array([n - 1 - int(np.argmin(hashed[::-1]))])
    else:
        views = np.lib.stride_tricks.sliding_window_view(hashed, window)
        at = np.unique(np.arange(len(views)) + views.argmin(axis=1))
    return at, hashed[at]


CHUNK = "chunk long, bytes long, docs array<long>, marks array<long>, texts array<binary>"


def text_mark(text) -> Column:
    """Tells texts apart by 64 bits."""
    return F.xxhash64(text)


def chunks_of_texts(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """CHUNK rows of the distinct texts, each under its smallest doc_id."""
    first = docs.groupBy("text").agg(F.min("doc_id").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def chunk() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            lists = [pa.array([rows.column(c).to_pylist()], pa.list_(t)) for c, t in (("doc_id", pa.int64()), ("mark", pa.int64()), ("text", pa.binary()))]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), *lists], ["chunk", "bytes", "docs", "marks", "texts"])

        for batch in batches:
            for part in slices(batch, "text", chunk_bytes // 4):
                own = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if held and size + own > chunk_bytes:
                    yield chunk()
                    number, held, size = number + 1, [], 0
                held.append(part)
                size += own
        if held:
            yield chunk()

    rows = first.select("doc_id", text_mark(F.col("text")).alias("mark"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, CHUNK)


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            docs, marks, texts = (batch.column(c)[i].values for c in ("docs", "marks", "texts"))
            yield batch.column("chunk")[i].as_py(), docs.to_numpy(), marks.to_numpy(), texts.to_pylist()


def _by_chunk(rows: DataFrame, name: str, *order: str) -> str:
    """Folder with a part for each chunk, so that the texts need not travel to meet the rows."""
    path = fresh_folder(rows.sparkSession, name)
    rows.repartition("chunk").sortWithinPartitions("chunk", *order).write.partitionBy("chunk").parquet(path)
    return path


def _told(store: fs.FileSystem, folder: str, chunk: int) -> list[pa.Table]:
    """The chunk's part of a folder; a chunk that is told nothing has none."""
    tables = []
    for name in (f.path for f in store.get_file_info(fs.FileSelector(f"{folder}/chunk={chunk}", allow_not_found=True))):
        if name.endswith(".parquet"):
            with store.open_input_file(name) as opened:
                tables.append(pq.read_table(opened))
    return tables


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - SHORT_BITS)


def _distinct(seeds_of: list[np.ndarray], ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ascending short hashes of a chunk, whether two of its texts hold them, ends of the ranges)."""
    each = [np.unique(_short(h)) for h in seeds_of]
    values, held = np.unique(np.concatenate([np.zeros(0, np.uint64), *each]), return_counts=True)
    where = values * np.uint64(ranges) >> np.uint64(SHORT_BITS)
    return values, held > 1, np.searchsorted(where, np.arange(ranges + 1, dtype=np.uint64))


def numbered_texts(chunks: DataFrame) -> DataFrame:
    """(chunk, index, doc_id, mark, tid): texts are numbered in the order of doc_id and mark."""
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("docs", "marks")).alias("index", "k"))
    keys = each.select("chunk", "index", F.col("k.docs").alias("doc_id"), F.col("k.marks").alias("mark"))
    return dense_index(keys, ["doc_id", "mark"], "tid").select("chunk", "index", "doc_id", "mark", "tid")


def repeated_seeds(chunks: DataFrame, texts: DataFrame, k: int = SEED_WORDS, window: int = WINDOW, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(at, seed) of the seeds that two or more different texts hold; at: tid and place.

    A few others come along by chance, since only SHORT_BITS of a hash are compared.
    """
    spark = chunks.sparkSession
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    ranges = min(1 << 15, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // range_bytes)))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, _, texts in _chunk_rows(batches):
            values, twice, ends = _distinct([minimizers(word_list(t), k, window)[1] for t in texts], ranges)
            rows = []
            for r in np.flatnonzero(np.diff(ends)):
                mine = values[ends[r] : ends[r + 1]]
                steps = np.diff(mine)
                kind = "<u4" if not len(steps) or steps.max() < 1 << 32 else "<u8"
                rows.append((int(r), chunk, int(mine[0]), kind, steps.astype(kind).tobytes(), np.packbits(twice[ends[r] : ends[r + 1]]).tobytes()))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["range", "chunk", "first", "kind", "steps", "twice"])

    def answer(told: pa.Table) -> pa.Table:
        """For each chunk of a range a bit for each hash: two or more texts hold it."""
        values, twice, sizes = [], [], []
        for first, kind, steps, bits in zip(*(told.column(c).to_pylist() for c in ("first", "kind", "steps", "twice"))):
            mine = np.cumsum(np.r_[np.uint64(first), np.frombuffer(steps, kind).astype(np.uint64)], dtype=np.uint64)
            values.append(mine)
            sizes.append(len(mine))
            twice.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(mine)).astype(bool))
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        line = every[order]
        same = line[1:] == line[:-1]
        held = np.empty(len(every), bool)
        held[order] = np.r_[False, same] | np.r_[same, False]
        bits = np.split(held | np.concatenate(twice), np.cumsum(sizes)[:-1])
        return pa.table([told.column("chunk"), told.column("range"), pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())], ["chunk", "range", "bits"])

    told = chunks.mapInArrow(tell, "range int, chunk long, first long, kind string, steps binary, twice binary")
    answers = told.groupBy("range").applyInArrow(answer, "chunk long, range int, bits binary")
    path = _by_chunk(answers, "repeated")
    numbers = texts.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("index", "tid"))).alias("t"))  # a chunk is bounded
    tids_path = _by_chunk(numbers.select("chunk", F.col("t.tid").alias("tids")), "repeated-tids")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (store, base), (_, tids_base) = open_store(path), open_store(tids_path)

        def told_of(folder: str, chunk: int) -> list[dict]:
            return [row for table in _told(store, folder, chunk) for row in table.to_pylist()]

        for chunk, _, _, whole in _chunk_rows(batches):
            found = [minimizers(word_list(t), k, window) for t in whole]
            values, _, ends = _distinct([h for _, h in found], ranges)
            if not len(values):
                continue
            repeated = np.zeros(len(values), bool)
            for r in told_of(base, chunk):
                x, y = ends[r["range"]], ends[r["range"] + 1]
                repeated[x:y] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=y - x)
            values = values[repeated]
            if not len(values):
                continue
            (tids,) = (r["tids"] for r in told_of(tids_base, chunk))
            places, seeds = [], []
            for tid, (at, hashes) in zip(tids, found):
                short = _short(hashes)
                hit = np.flatnonzero(values[np.minimum(np.searchsorted(values, short), len(values) - 1)] == short)
                places.append((tid << PLACE_BITS) + at[hit])
                seeds.append(hashes[hit].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(places)), pa.array(np.concatenate(seeds))], ["at", "seed"])

    return chunks.mapInArrow(keep, "at long, seed long")


def fragments(pair: np.ndarray, pa_: np.ndarray, pb: np.ndarray, words: np.ndarray, window: int) -> np.ndarray:
    """Merge matches of each pair along diagonals: rows (pair, start a, start b, words), pair by pair."""
    order = np.lexsort((pb, pb - pa_, pair))
    pair, a, b, end = pair[order], pa_[order], pb[order], (pb + words)[order]
    turn = np.r_[False, (np.diff(b - a) != 0) | (np.diff(pair) != 0)]
    shift = np.cumsum(turn) * (int(end.max()) + 1)
    end = np.maximum.accumulate(end + shift) - shift  # so far, along the diagonal
    new = turn | np.r_[True, b[1:] > end[:-1] + window]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(a)] - 1
    return np.stack([pair[first], a[first], b[first], end[last] - b[first]], axis=1)


class _Fenwick:
    """Prefix maxima of (score, index) over ranks."""

    def __init__(self, size: int):
        self.best = [(float("-inf"), -1)] * (size + 1)

    def put(self, rank: int, item: tuple[float, int]) -> None:
        rank += 1
        while rank < len(self.best):
            self.best[rank] = max(self.best[rank], item)
            rank += rank & -rank

    def upto(self, count: int) -> tuple[float, int]:
        out = (float("-inf"), -1)
        while count > 0:
            out = max(out, self.best[count])
            count -= count & -count
        return out


def chains(parts: np.ndarray, cost: float = GAP_COST, reach: int = REACH) -> list[np.ndarray]:
    """Collinear chains of fragments, best first; a fragment is in one chain at most.

    score(i) = words(i) + max over fragments j that end before i on both sides of
    score(j) - cost * (gap a + gap b). The cost is a sum of coordinates, so a Fenwick tree of
    prefix maxima over the ends on side b serves the fragments in order of side a. Chains
    break where a gap is beyond reach.
    """
    n = len(parts)
    if n == 1:
        return [parts]
    sa, sb, size = parts.T
    ea, eb = sa + size, sb + size
    ranks = np.unique(eb, return_inverse=True)
    tree = _Fenwick(len(ranks[0]))
    events = sorted([(int(sa[i]), 1, i) for i in range(n)] + [(int(ea[i]), 0, i) for i in range(n)])
    score, before = [0.0] * n, [-1] * n
    for _, starts, i in events:
        if starts:
            count = int(np.searchsorted(ranks[0], sb[i], "right"))
            value, j = tree.upto(count)
            gain = value - cost * float(sa[i] + sb[i])
            score[i] = float(size[i])
            if j >= 0 and gain > 0:
                score[i] += gain
                before[i] = j
        else:
            tree.put(int(ranks[1][i]), (score[i] + cost * float(ea[i] + eb[i]), i))
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain, at = [], i
        while at >= 0 and not used[at]:
            if chain and max(sa[chain[-1]] - ea[at], sb[chain[-1]] - eb[at]) > reach:
                break
            used[at] = True
            chain.append(at)
            at = before[at]
        if chain:
            out.append(parts[chain[::-1]])
    return out


def common_words(x: list, y: list) -> int:
    """Length of the longest common subsequence of two short word lists."""
    row = [0] * (len(y) + 1)
    for w in x:
        diagonal = 0
        for j, v in enumerate(y, 1):
            diagonal, row[j] = row[j], diagonal + 1 if w == v else max(row[j], row[j - 1])
    return row[-1]


EDITS = ((1, 1), (0, 1), (1, 0), (2, 2))  # words passed over on either side


def _stands_alone(left: bytes, right: bytes, a: int, b: int, n: int, least: int) -> bool:
    """Whether a run of equal words, grown as far as they agree, is short and `_stretch` would end there.

    Words are codes of two bytes. This spares most chains of one seed the alignment.
    """
    i, j, u, v = a - 1, b - 1, a + n, b + n
    while i >= 0 and j >= 0 and left[2 * i : 2 * i + 2] == right[2 * j : 2 * j + 2]:
        i, j = i - 1, j - 1
    ends = len(left) // 2, len(right) // 2
    while u < ends[0] and v < ends[1] and left[2 * u : 2 * u + 2] == right[2 * v : 2 * v + 2]:
        u, v = u + 1, v + 1
    if u - i - 1 >= least:
        return False
    for da, db in EDITS:  # three words must agree behind an edit
        p, q = i - da, j - db
        if p >= 2 and q >= 2 and left[2 * p - 4 : 2 * p + 2] == right[2 * q - 4 : 2 * q + 2]:
            return False
        p, q = u + da, v + db
        if p + 3 <= ends[0] and q + 3 <= ends[1] and left[2 * p : 2 * p + 6] == right[2 * q : 2 * q + 6]:
            return False
    return True


def _stretch(x: list, y: list, i: int, j: int, step: int) -> tuple[int, int, int]:
    """Go on from (i, j) while words agree, passing over single edits; (i, j, words matched)."""
    inside = lambda a, b: 0 <= a < len(x) and 0 <= b < len(y)
    agree = lambda a, b: inside(a, b) and x[a] == y[b]
    matched = 0
    while True:
        while agree(i, j):
            matched, i, j = matched + 1, i + step, j + step
        for da, db in EDITS:
            a, b = i + da * step, j + db * step
            if all(agree(a + n * step, b + n * step) for n in range(3)):
                i, j = a, b
                break
        else:
            return i, j, matched


def _window(chain: list[tuple[int, int, int]], margin: int) -> tuple[int, int, int, int]:
    """(a0, a1, b0, b1) of a chain's slices, `margin` words around it in whole steps of ten, so that equal passages ask for equal slices."""
    (a0, b0, _), (a1, b1, n) = chain[0], chain[-1]
    lo = lambda v: max(0, v - margin) // 10 * 10
    hi = lambda v: (v + margin + 9) // 10 * 10
    return lo(a0), hi(a1 + n), lo(b0), hi(b1 + n)


def _chains_to(found: list[list[tuple[int, int, int]]]) -> bytes:
    """Chains as bytes: of each the number of its fragments, then these."""
    return np.array([v for chain in found for v in (len(chain), *(w for part in chain for w in part))], "<i8").tobytes()


def _chains_in(raw: bytes) -> list[list[tuple[int, int, int]]]:
    flat, out, at = memoryview(raw).cast("q").tolist(), [], 0
    while at < len(flat):
        end = at + 1 + 3 * flat[at]
        out.append([tuple(flat[i : i + 3]) for i in range(at + 1, end, 3)])
        at = end
    return out


def _side_by_side(found: list[list[tuple[int, int, int]]], margin: int, most: int = REGION) -> Iterator[tuple]:
    """(a0, a1, b0, b1, chains): chains of one pair whose slices overlap in the later text share a row, up to `most` words on either side.

    A text that repeats itself has a chain for each repeat, and they lie over one another.
    """
    held, span = [], None
    for window, chain in sorted(((_window(c, margin), c) for c in found), key=lambda wc: (wc[0][0] // most, wc[0][2], wc[0][0])):
        if held:
            both = (min(span[0], window[0]), max(span[1], window[1]), min(span[2], window[2]), max(span[3], window[3]))
            if window[2] > span[3] or max(both[1] - both[0], both[3] - both[2]) > most:
                yield *span, held
                held = []
        held, span = (held + [chain], both) if held else ([chain], window)
    if held:
        yield *span, held


def _cut_to(chain: list[tuple[int, int, int]], a0: int, b0: int, margin: int) -> tuple[list[tuple[int, int, int]], tuple[int, int, int, int]]:
    """(a chain counted from the start of its own slices, these within the row's slices from a0 and b0)."""
    lo_a, hi_a, lo_b, hi_b = _window(chain, margin)
    return [(a - lo_a, b - lo_b, n) for a, b, n in chain], (lo_a - a0, hi_a - a0, lo_b - b0, hi_b - b0)


def align(x: list, y: list, chain: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Align two word lists along a chain; (start a, end a, start b, end b, words matched).

    A chain that turns out too loose is cut at its widest gap and both parts are tried.
    """
    pieces: list[tuple[int, int, int]] = []
    for a, b, size in chain:
        if pieces:  # overlapping fragments are trimmed
            pa_, pb, n = pieces[-1]
            over = max(0, pa_ + n - a, pb + n - b)
            a, b, size = a + over, b + over, size - over
        if size > 0:
            pieces.append((a, b, size))
    if not pieces:
        return []
    gaps, inside = [], sum(sum(x[a + i] == y[b + i] for i in range(n)) for a, b, n in pieces)
    for (a, b, n), (c, d, _) in zip(pieces, pieces[1:]):
        left, right = x[a + n : c], y[b + n : d]
        gaps.append((max(len(left), len(right)), common_words(left, right)))
    a, b, _ = pieces[0]
    i, j, before = _stretch(x, y, a - 1, b - 1, -1)
    a, b, n = pieces[-1]
    u, v, after = _stretch(x, y, a + n, b + n, 1)
    matched = inside + sum(m for _, m in gaps) + before + after
    span = (i + 1, u, j + 1, v, matched)
    if matched >= SIMILARITY * max(span[1] - span[0], span[3] - span[2]) or not gaps:
        return [span]
    widest = max(range(len(gaps)), key=lambda g: gaps[g][0] - gaps[g][1])
    cut = widest + 1
    return align(x, y, pieces[:cut]) + align(x, y, pieces[cut:])


PAIR = "a long, b long"
CHAINS = f"{PAIR}, a0 long, a1 long, b0 long, b1 long, chains binary"


def _linked(found: DataFrame, name: str, rare: int = RARE) -> DataFrame:
    """(at, seed, words, hub, last) of every repeated seed: its first occurrence; if it is rare, its last one."""
    # The first occurrences are combined before their shuffle and stored, so that the join
    # stands alone and a seed of very many occurrences can be split over tasks.
    hubs = found.groupBy("seed", "words").agg(F.count(F.lit(1)).alias("times"), F.min("at").alias("hub"), F.max("at").alias("last"))
    few = F.when(F.col("times").between(3, rare), F.col("last")).otherwise(F.lit(-1)).alias("last")
    hubs = stored(hubs.where("times > 1").select("seed", "words", "hub", few), name)
    return found.join(hubs, ["seed", "words"]).select("at", "seed", "words", "hub", "last")


RUNS = "sequence boolean, a long, b long, pa long, pb long, words long"


def _runs(links: DataFrame, k: int, lengths: list[int]) -> DataFrame:
    """RUNS of links: places of a text whose links go on in step, as one row with its words.

    With lengths also sequences of repeated seeds whose first occurrences lie apart: rows with
    `sequence`, their place in `a` and a hash in `b`. A sequence whose seeds all have their first
    occurrences in a row is linked to its own first occurrence by them already. Whether that is so
    depends on its words alone, so it holds for all its occurrences or for none.
    """
    steps, low = [n - k + 1 for n in lengths], (1 << PLACE_BITS) - 1
    names = [f.split()[0] for f in RUNS.split(", ")]

    def batch_of(sequence: bool, rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(rows.shape[1], sequence)), *map(pa.array, rows)], names)

    def runs(rows: np.ndarray, target: np.ndarray) -> pa.RecordBatch:
        """Of links to `target`; those within a text are left out."""
        at, words = rows[:, 0], rows[:, 2]
        use = (target >= 0) & (target >> PLACE_BITS != at >> PLACE_BITS)
        at, words, target = at[use], words[use], target[use]
        new = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(target) != 1) | (np.diff(words) != 0)]) if len(at) else np.zeros(0, int)
        size = np.diff(np.r_[new, len(at)]) - 1 + words[new]
        x, y = np.minimum(at[new], target[new]), np.maximum(at[new], target[new])
        return batch_of(False, np.stack([x >> PLACE_BITS, y >> PLACE_BITS, x & low, y & low, size]))

    def sequences(rows: np.ndarray, starts: int) -> pa.RecordBatch:
        at_, seed, _, hub = rows.T[:4]
        broken = np.r_[0, np.cumsum(np.diff(at_) != 1)]
        apart = np.r_[0, np.cumsum(np.diff(hub) != 1)]
        out = [np.zeros((5, 0), np.int64)]
        for n, step in zip(lengths, steps):
            at = np.arange(max(0, min(starts, len(rows) - step + 1)))
            at = at[(broken[at + step - 1] == broken[at]) & (apart[at + step - 1] != apart[at])]
            mixed = np.zeros(len(at), np.uint64)
            for j in range(step):
                mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + seed[at + j].view(np.uint64)
                mixed ^= mixed >> np.uint64(29)
            nothing = np.zeros(len(at), np.int64)
            out.append(np.stack([at_[at], mixed.view(np.int64), nothing, nothing, np.full(len(at), n)]))
        return batch_of(True, np.concatenate(out, axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, most = np.zeros((0, 5), np.int64), max(steps, default=1)
        for batch in batches:
            now = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            for column in (3, 4):
                yield runs(now, now[:, column])
            if steps:
                held = np.concatenate([held, now])
                done = len(held) - most
                if done > 0:
                    yield sequences(held, done)
                    held = held[done:]
        if steps:
            yield sequences(held, len(held))

    mine = links.repartition(F.shiftright("at", PLACE_BITS)).sortWithinPartitions("words", "at")
    return mine.mapInArrow(run, RUNS)


def _chained(matches: DataFrame, window: int, margin: int) -> DataFrame:
    """Chains of every pair of documents, with the slices of `margin` words around them."""

    names = [f.split()[0] for f in CHAINS.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def single(rows: np.ndarray) -> pa.RecordBatch:
        """Rows of pairs with one fragment each (a, b, pa, pb, words)."""
        a, b, x, y, words = rows.T
        ends = [np.maximum(0, x - margin) // 10 * 10, (x + words + margin + 9) // 10 * 10]
        ends += [np.maximum(0, y - margin) // 10 * 10, (y + words + margin + 9) // 10 * 10]
        raw = pa.py_buffer(np.column_stack([np.ones(len(rows), "<i8"), rows[:, 2:]]).astype("<i8").tobytes())
        places = pa.py_buffer((np.arange(len(rows) + 1) * 32).astype(np.int32).tobytes())
        chain = pa.Array.from_buffers(pa.binary(), len(rows), [None, places, raw])
        return pa.RecordBatch.from_arrays([*map(pa.array, (a, b, *ends)), chain], names)

    def whole(held: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of whole pairs; their matches are merged together, and most pairs have one fragment only."""
        starts = np.r_[0, np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1)) + 1]
        number = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(held)]))
        parts = fragments(number, *held[:, 2:].T, window)
        ends = np.cumsum(np.bincount(parts[:, 0], minlength=len(starts)))
        first = np.r_[0, ends[:-1]]
        one = ends - first == 1
        if one.any():
            yield single(np.column_stack([held[starts[one], :2], parts[first[one], 1:]]))
        rows = []
        for key, start, end in zip(held[starts[~one], :2].tolist(), first[~one], ends[~one]):
            found = [[tuple(part) for part in chain.tolist()] for chain in chains(parts[start:end, 1:])]
            rows += [(*key, *span, _chains_to(own)) for *span, own in _side_by_side(found, margin)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 5), np.int64)
        for batch in batches:
            now = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "pa", "pb", "words")], axis=1)
            held = np.concatenate([held, now])
            edge = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1)) + 1
            if len(edge):  # the last pair may go on in the next batch
                yield from whole(held[: edge[-1]])
                held = held[edge[-1] :]
        if len(held):
            yield from whole(held)

    keys = ["a", "b"]
    return matches.repartition(*keys).sortWithinPartitions(*keys, "pb", "pa").mapInArrow(run, CHAINS)


def word_codes(tokens: list[bytes]) -> bytes:
    """Two bytes for each word; equal words have equal codes."""
    return np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens)).astype("<u2").tobytes()


def _slices(chunks: DataFrame, texts: DataFrame, pairs: DataFrame, coded: bool) -> tuple[DataFrame, DataFrame]:
    """pairs with their words a0 to a1 and b0 to b1 as `left` and `right`, codes or one text; the stored slices."""

    sides = [pairs.select(F.col(c).alias("tid"), F.col(f"{c}0").alias("lo"), F.col(f"{c}1").alias("hi")) for c in "ab"]
    asked = sides[0].union(sides[1]).distinct().join(texts.select("tid", "chunk", "index"), "tid")
    path = _by_chunk(asked, "asked", "index", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(path)
        for chunk, _, _, texts in _chunk_rows(batches):
            for table in _told(store, base, chunk):
                index, tid, lo, hi = (table.column(c).to_numpy() for c in ("index", "tid", "lo", "hi"))
                edges = np.r_[np.flatnonzero(np.diff(index, prepend=-1)), len(index)]
                out, size, start = [], 0, 0
                for x, y in zip(edges, edges[1:]):
                    words = word_list(texts[index[x]])
                    words = word_codes(words) if coded else words
                    for n in range(x, y):
                        out.append(words[2 * lo[n] : 2 * hi[n]] if coded else b" ".join(words[lo[n] : hi[n]]))
                        size += len(out[-1])
                        if size > SLICE_BYTES or n + 1 == len(index):
                            columns = [pa.array(c[start : n + 1]) for c in (tid, lo, hi)]
                            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], ["tid", "lo", "hi", "part"])
                            out, size, start = [], 0, n + 1

    parts = stored(chunks.mapInArrow(run, "tid long, lo long, hi long, part binary"), "codes" if coded else "slices")
    removed(chunks.sparkSession, path)
    side = lambda s, name: parts.select(F.col("tid").alias(s), F.col("lo").alias(f"{s}0"), F.col("hi").alias(f"{s}1"), F.col("part").alias(name))
    return pairs.join(side("a", "left"), ["a", "a0", "a1"]).join(side("b", "right"), ["b", "b0", "b1"]), parts


def _hopeful(pairs: DataFrame, least: int, similarity: float) -> DataFrame:
    """Chains whose alignment on the words' codes is long and similar enough."""

    def hopeful(left: bytes, right: bytes, chain: list[tuple[int, int, int]]) -> bool:
        if len(chain) == 1 and _stands_alone(left, right, *chain[0], least):
            return False
        x, y = memoryview(left).cast("H"), memoryview(right).cast("H")
        return any(
            min(u - i, v - j) >= least and matched >= similarity * max(u - i, v - j)
            for i, u, j, v, matched in align(x, y, chain)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [f.split()[0] for f in CHAINS.split(", ")], [pa.int64()] * 6 + [pa.binary()]
        for batch in (part for whole in batches for part in slices(whole, "left", SLICE_BYTES)):
            rows = []
            for a, b, a0, b0, raw, left, right in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "a0", "b0", "chains", "left", "right"))):
                kept = []
                for chain in _chains_in(raw):
                    own, (p, q, r, t) = _cut_to(chain, a0, b0, least)
                    if hopeful(left[2 * p : 2 * q], right[2 * r : 2 * t], own):
                        kept.append(chain)
                rows += [(a, b, *span, _chains_to(held)) for *span, held in _side_by_side(kept, least)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return pairs.mapInArrow(run, CHAINS)


SPANS = "doc_id long, mark long, start long, end long, source_id long, source_start long, source_end long, matched long, similarity double"


def _aligned(pairs: DataFrame, least: int, similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [f.split()[0] for f in SPANS.split(", ")], [pa.int64()] * 8 + [pa.float64()]
        for batch in (part for whole in batches for part in slices(whole, "left", SLICE_BYTES)):
            rows = []
            for r in batch.to_pylist():
                left, right = r["left"].split(b" "), r["right"].split(b" ")
                for chain in _chains_in(r["chains"]):
                    own, (p, q, b, e) = _cut_to(chain, r["a0"], r["b0"], least)
                    for i, u, j, v, matched in align(left[p:q], right[b:e], own):
                        share = matched / max(u - i, v - j)
                        if min(u - i, v - j) >= least and share >= similarity:
                            at, source = r["b0"] + b, r["a0"] + p
                            rows.append((r["doc_id"], r["mark"], j + at, v + at, r["source_id"], i + source, u + source, matched, share))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return pairs.mapInArrow(run, SPANS)


def _copies(rows: DataFrame, least: int) -> DataFrame:
    """SPANS of the documents whose whole text stands under a smaller doc_id."""
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    told = rows.select("doc_id", text_mark(F.col("text")).alias("mark"), words.alias("n"))
    told = stored(told.where(F.col("n") >= least).distinct(), "long-texts")
    first = told.groupBy("mark").agg(F.min("doc_id").alias("source_id"), F.max("doc_id").alias("last")).where("source_id < last")
    copies = told.join(stored(first.drop("last"), "copied-texts"), "mark").where("doc_id > source_id")
    zero = F.lit(0).cast("long")
    return copies.select(
        "doc_id", "mark", zero.alias("start"), F.col("n").alias("end"), "source_id", zero.alias("source_start"), F.col("n").alias("source_end"),
        F.col("n").alias("matched"), F.lit(1.0).alias("similarity"),
    )


def repeated_passages(
    docs: DataFrame,
    least: int = MIN_WORDS,
    similarity: float = SIMILARITY,
    k: int = SEED_WORDS,
    window: int = WINDOW,
) -> DataFrame:
    """Passages of docs (doc_id, text) that an earlier document holds too.

    One row for each: doc_id, mark (tells texts under one doc_id apart), start and end in words,
    the earliest document found with it and the place there (source_*), the words matched and
    their share of the longer side. Texts are taken whole, whatever their length. A passage's first holder, by doc_id, has no row for it. Rows with a null doc_id or
    text take no part; repeated rows count once; documents that share a doc_id are told apart
    by their text; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    chunks = swept(stored(chunks_of_texts(rows), "chunks"))
    texts = stored(numbered_texts(chunks), "texts")
    found = stored(repeated_seeds(chunks, texts, k, window).withColumn("words", F.lit(k).cast("long")), "seeds")
    swept(found)
    lengths = sorted({n for n in (k + 1, 2 * k, 4 * k) if n < least} | {least}) if window == 1 and least > k else []
    runs = stored(_runs(_linked(found, "hubs"), k, lengths), "runs")
    spent(found)
    matches = runs.where("NOT sequence")
    if lengths:
        longer = runs.where("sequence").select(F.col("a").alias("at"), F.col("b").alias("seed"), "words")
        matches = matches.union(stored(_runs(_linked(longer, "sequence-hubs"), k, []), "sequence-runs"))
    swept(runs)
    chained = stored(_chained(matches.drop("sequence"), window, least), "chains")
    spent(runs)
    coded, codes = _slices(chunks, texts, chained, True)
    hopeful = stored(_hopeful(coded, least, similarity), "hopeful")
    spent(codes)
    spent(chained)
    here = texts.select(F.col("tid").alias("b"), "doc_id", "mark")
    there = texts.select(F.col("tid").alias("a"), F.col("doc_id").alias("source_id"))
    named = stored(hopeful.join(here, "b").join(there, "a"), "named")  # before the slices, which are wide
    spent(hopeful)
    pairs, cut = _slices(chunks, texts, named, False)
    spent(chunks)
    passages = stored(_aligned(pairs.select("doc_id", "mark", "source_id", "a0", "b0", "chains", "left", "right"), least, similarity), "spans")
    spent(cut)
    spent(named)
    rest = ["source_id", "source_start", "source_end", "matched", "similarity"]
    place = ["doc_id", "mark", "start", "end"]
    first = passages.union(_copies(rows, least)).groupBy(*place).agg(F.min(F.struct(*rest)).alias("s"))
    return first.select(*place, "s.*")


def merged_spans(passages: DataFrame) -> DataFrame:
    """Passages of a document joined where they overlap: doc_id, mark, start, end, source_id."""
    order = Window.partitionBy("doc_id", "mark").orderBy("start", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opened = passages.withColumn("new", F.when(F.col("start") <= F.max("end").over(before), 0).otherwise(1))
    numbered = opened.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc_id", "mark", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("source_id").alias("source_id")
    ).drop("run")


def cut_words(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A UTF-8 text without the words of the given spans; what stands between words is kept."""
    import re

    found = [m.span() for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+", raw)]
    out, at = [], 0
    for start, end in sorted(spans):
        start, end = max(0, start), min(end, len(found))
        if start >= end or found[start][0] < at:
            continue
        out.append(raw[at : found[start][0]])
        at = found[end][0] if end < len(found) else len(raw)
    return b"".join([*out, raw[at:]])


def without_repeats(docs: DataFrame, **settings) -> DataFrame:
    """docs without the passages earlier documents hold; texts left without a word are dropped.

    Other rows and all columns stay as they are; n_chars, where there is one, is counted anew
    for changed texts.
    """
    spans = merged_spans(repeated_passages(docs, **settings)).groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("start", "end")).alias("__spans")
    )  # no more spans than a text has passages
    spans = spans.select(F.col("doc_id").alias("__d"), F.col("mark").alias("__t"), "__spans")
    joined = docs.join(
        spans, (F.col("doc_id") == F.col("__d")) & (text_mark(F.col("text")) == F.col("__t")), "left"
    ).drop("__d", "__t")
    changed = joined.where("__spans IS NOT NULL")
    same = joined.where("__spans IS NULL").drop("__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            spans = batch.column("__spans").to_pylist()
            new = [cut_words(t, [(s["start"], s["end"]) for s in own]) for t, own in zip(texts, spans)]
            keep = pa.array([bool(t.split()) for t in new], pa.bool_())
            out = batch.set_column(at, "text", pa.array(new, pa.binary()).cast(pa.string())).drop_columns(["__spans"])
            yield out.filter(keep)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    cut = changed.mapInArrow(run, fields)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same.unionByName(cut)
