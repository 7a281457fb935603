"""What the operators share: words, stored intermediates, shared-folder files, encoding."""

from __future__ import annotations

import gc
import os
import re
import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmotion.session import scratch_path

# Words are runs of anything but these separators; only A-Z is lower-cased.
SEPARATORS = "[\\x20\\x09-\\x0D]+"
# A space behind other white space, as Python knows it.
UNSAFE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
# A word's letters and what follows them: no pattern joins a letter to the mark behind it, but for an apostrophe.
TAILED = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([\t-\r!-&(-@\[-`{-~].*)", re.DOTALL)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Lower-cased words as an array; null text has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, removed when the driver program ends."""
    return scratch_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts lineage and survives lost executors; the rows are computed once.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def swept(df: DataFrame) -> DataFrame:
    """df, after the shuffle files of finished jobs are freed; Spark keeps them until their plans are collected."""
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return df


def removed(spark: SparkSession, folder: str) -> None:
    """Remove a folder of the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spent(df: DataFrame) -> None:
    """Remove stored rows that nothing reads any more."""
    removed(df.sparkSession, df._stored_at)
    swept(df)


def open_store(uri: str):
    """(file system, path) for a folder that tasks write to and read from directly."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:") :].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_once(uri: str, stem: str, suffix: str):
    """(path, open stream) of a file no other attempt of the task writes."""
    store, base = open_store(uri)
    store.create_dir(base, recursive=True)
    path = f"{base}/{stem}-{uuid.uuid4().hex}{suffix}"
    return path, store.open_output_stream(path)


def slices(batch: pa.RecordBatch, column: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `most` bytes of text, one row at least."""
    size = np.cumsum(
        pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False),
        dtype=np.int64,
    )
    start = 0
    while start < batch.num_rows:
        done = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, done + most, "right")))
        yield batch.slice(start, end - start)
        start = end


class Encoder:
    """Token ids of whole texts by a byte-level BPE of the tokenizers library.

    The vocabulary's pattern never joins a space to what precedes it, so a text falls into
    pieces before each space, and a piece has the same ids wherever it stands. Only new
    pieces are encoded, a few hundred at a time; a token that starts with a space starts a
    piece. Of a piece that ends in marks the letters and the rest are encoded apart, so that a word
    is learnt once. Where a space follows other white space the pattern looks across it, and such a
    text is encoded as it is. The string of a special token is that token, as in the library's
    plain call.
    """

    CACHE = 300_000  # pieces a worker keeps, some 70 MB; the others are encoded again
    TOGETHER = 256

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        import tokenizers

        # The module outlives a task in a worker that Spark reuses, and so do the pieces.
        kept = vars(tokenizers).setdefault("_pieces_by_file", {})
        if path not in kept:
            tokenizer = tokenizers.Tokenizer.from_file(path)
            size = tokenizer.get_vocab_size()
            led = np.array([(tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
            # An added token that begins with a letter, or looks at what stands beside it, may reach over a cut.
            added = tokenizer.get_added_tokens_decoder().values()
            cuts = not any(t.content[:1].isalpha() or t.single_word or t.lstrip or t.rstrip for t in added)
            kept[path] = (tokenizer, led, {}, {}, cuts)
        self.tokenizer, self.led, self.pieces, self.heads, self.cuts = kept[path]

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        out, simple, tailed = {}, {}, {}
        for piece in new:
            if not piece or len(piece) > 200 or piece != piece.strip():
                out[piece] = self._plain(" " + piece).tobytes()
            elif not piece.isalpha() and self.cuts and (cut := TAILED.fullmatch(piece)):
                tailed[piece] = cut.groups()
            else:
                simple[piece] = None
        simple.update((head, None) for head, _ in tailed.values() if head not in self.pieces)
        heads = list(simple)
        groups = [heads[i : i + self.TOGETHER] for i in range(0, len(heads), self.TOGETHER)]
        joined = [" " + " ".join(group) for group in groups]
        encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        for group, one in zip(groups, encoded):
            ids = np.array(one.ids, np.uint32)
            starts = np.flatnonzero(self.led[ids])
            if len(starts) == len(group):
                raw = ids.tobytes()
                ends = [*(starts[1:] * 4).tolist(), len(raw)]
                for piece, a, b in zip(group, (starts * 4).tolist(), ends):
                    out[piece] = raw[a:b]
            else:
                for piece in group:
                    out[piece] = self._plain(" " + piece).tobytes()
        tails = list({tail for _, tail in tailed.values()})
        ends = self.tokenizer.encode_batch_fast(tails, add_special_tokens=False)
        end = {tail: np.array(one.ids, np.uint32).tobytes() for tail, one in zip(tails, ends)}
        for piece, (head, tail) in tailed.items():
            out[piece] = (out[head] if head in out else self.pieces[head]) + end[tail]
        self.pieces.update(islice(out.items(), max(0, self.CACHE - len(self.pieces))))
        return out

    def _head(self, piece: str) -> np.ndarray:
        if piece not in self.heads:
            if len(self.heads) > 100_000:
                self.heads.clear()
            self.heads[piece] = self._plain(piece)
        return self.heads[piece]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit arrays; null is empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, UNSAFE).to_pylist()
        parts = pc.split_pattern(texts, " ")
        coded = parts.flatten().dictionary_encode()
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        vocabulary = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # some ten times as fast as to_pylist
        found = list(map(self.pieces.get, vocabulary))
        missing = [i for i, raw in enumerate(found) if raw is None]
        fresh = self._learn([vocabulary[i] for i in missing]) if missing else {}
        for i in missing:
            found[i] = fresh[vocabulary[i]]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        begin = np.cumsum(size) - size
        index = coded.indices.to_numpy()
        out = []
        for i, unsafe in enumerate(odd):
            if unsafe:
                segments = re.split(r"(?<=\S)(?= )", texts[i].as_py())
                out.append(np.concatenate([self._plain(s) for s in segments]))
                continue
            mine = index[offsets[i] + 1 : offsets[i + 1]]
            head = self._head(vocabulary[index[offsets[i]]])
            lengths = size[mine]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            at = np.repeat(begin[mine] - (ends - lengths), lengths) + np.arange(total)
            out.append(np.concatenate([head, flat[at]]))
        return out
