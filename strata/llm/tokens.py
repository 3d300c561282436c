"""Token ids in binary files with Elias-Fano document boundaries.

A file holds the concatenated ids of consecutive documents and, instead of a table of 64-bit offsets, the Elias-Fano
code of the n + 1 document boundaries: the low bits of each boundary packed, the high parts in unary as a bit vector,
and a sampled select structure (the bit position of every ``SAMPLE``-th one).  Boundary i is ``select(i)`` plus its low
bits, about 2 + log2(ids / documents) bits per document.

Layout (little endian): magic ``EFT1``, then u32 id width in bytes, u64 documents, u64 ids, u32 low bits, u32 select
samples, u64 bytes of the low part, u64 bytes of the high part; then doc keys (i64 each), low part, high part, select
samples (u64 each), ids.

Writing: documents are range-partitioned by doc_id, each task encodes its documents in order and writes files of at
most ``file_ids`` ids to the shared folder under fresh names.  The names that count are those in the manifest, which is
itself written as Parquet: a retried task leaves at most an orphan file.  Offsets across files are running sums over the
manifest.
"""

from __future__ import annotations

import struct
import sys
import types
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir

MAGIC, HEAD, SAMPLE = b"EFT1", "<4sIQQIIQQ", 256
MANIFEST = "file string, pid int, seq int, n_docs bigint, n_ids bigint"
NULL_ID = -(1 << 63)


# ---- Elias-Fano ------------------------------------------------------------------------------------------------

def ef_encode(values: np.ndarray) -> tuple[int, bytes, bytes, np.ndarray]:
    """(low bits, packed low part, high bit vector, select samples) of a non-decreasing array."""
    v = np.asarray(values, np.uint64)
    n, top = len(v), int(v[-1]) if len(v) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    high = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)  # position of the i-th one
    vec = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    vec[high] = 1
    return (low, np.packbits(bits.ravel(), bitorder="little").tobytes(),
            np.packbits(vec, bitorder="little").tobytes(), high[::SAMPLE].astype("<u8"))


class EliasFano:
    """Reader: ``select`` finds the i-th one from the nearest sample, ``get`` adds the low bits."""

    def __init__(self, n: int, low: int, low_part: bytes, high_part: bytes, samples: np.ndarray):
        self.n, self.low, self.samples = n, low, samples
        self.lo, self.hi = np.frombuffer(low_part, np.uint8), np.frombuffer(high_part, np.uint8)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.int64)
        at = i[:, None] * self.low + np.arange(self.low)
        bit = (self.lo[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (bit.astype(np.int64) << np.arange(self.low)).sum(1)

    def select(self, i: int) -> int:
        start = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, start >> 3
        bits = np.unpackbits(self.hi[byte:byte + 1], bitorder="little")
        bits[:start & 7] = 0
        while True:
            ones = np.flatnonzero(bits)
            if left < len(ones):
                return byte * 8 + int(ones[left])
            left -= len(ones)
            byte += len(bits) >> 3
            bits = np.unpackbits(self.hi[byte:byte + 64], bitorder="little")

    def get(self, i: int) -> int:
        return ((self.select(i) - i) << self.low) + int(self._low(np.array([i]))[0])

    def block(self, i: int, j: int) -> np.ndarray:
        """Boundaries i .. j-1 from the samples around them."""
        i0 = i // SAMPLE * SAMPLE
        a = int(self.samples[i0 // SAMPLE])
        k = -(-j // SAMPLE)
        b = int(self.samples[k]) if k < len(self.samples) else len(self.hi) * 8
        bits = np.unpackbits(self.hi[a >> 3:(b + 7) >> 3], bitorder="little")
        bits[:a & 7] = 0
        pos = np.flatnonzero(bits)[i - i0:j - i0] + (a >> 3 << 3)
        idx = np.arange(i, j)
        return ((pos - idx) << self.low) + self._low(idx)


# ---- files -----------------------------------------------------------------------------------------------------

def pack(keys: list[int], lengths: list[int], ids: list[bytes], width: int) -> bytes:
    """One file's bytes; ``ids`` are the documents' ids as little-endian integers of ``width`` bytes."""
    bounds = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))])
    low, lo, hi, samples = ef_encode(bounds)
    head = struct.pack(HEAD, MAGIC, width, len(lengths), int(bounds[-1]), low, len(samples), len(lo), len(hi))
    return b"".join([head, np.asarray(keys, "<i8").tobytes(), lo, hi, samples.tobytes(), *ids])


class TokenFile:
    """Random access to one file: ``boundaries(i, j)`` by select, ``ids(start, end)`` by one ranged read."""

    def __init__(self, source):
        self.f = source
        (magic, self.width, self.n, self.n_ids, low, n_samples, n_lo, n_hi) = struct.unpack(HEAD, self._read(0, struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize(HEAD)
        self.keys = np.frombuffer(self._read(at, 8 * self.n), "<i8")
        at += 8 * self.n
        lo, hi = self._read(at, n_lo), self._read(at + n_lo, n_hi)
        samples = np.frombuffer(self._read(at + n_lo + n_hi, 8 * n_samples), "<u8")
        self.base = at + n_lo + n_hi + 8 * n_samples
        self.ef = EliasFano(self.n + 1, low, lo, hi, samples)

    def _read(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def boundaries(self, i: int, j: int) -> np.ndarray:
        return self.ef.block(i, j)

    def ids(self, start: int, end: int) -> np.ndarray:
        raw = self._read(self.base + start * self.width, (end - start) * self.width)
        return np.frombuffer(raw, f"<u{self.width}")


# ---- encoding --------------------------------------------------------------------------------------------------

class WordEncoder:
    """Byte-level BPE by the tokenizers library, each distinct word encoded once.

    The pre-tokenizer always starts a new piece at a single space or line feed between two characters that are not
    white space, so a text's ids are those of its space- and line-separated words one after another.  Words new to the
    cache go to the library together, one per line of a joined text (line feeds are a piece of their own).  Texts in
    which that does not hold (runs of white space, special tokens) go to the library whole.  The cache keeps two
    generations of ``limit`` words; its size changes nothing in the ids."""

    def __init__(self, path: str, limit: int = 700_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.limit = Tokenizer.from_file(path), limit
        self.width = 2 if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.feed = self._whole("\n")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, words: list[str]) -> None:
        feed = int(np.frombuffer(self.feed, self.kind)[0])
        for a in range(0, len(words), 500):
            part = words[a:a + 500]
            joined = "\n".join(part) + "\n"
            ids = np.array(self.tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(ids == feed)
            if len(ends) != len(part):
                raise ValueError("words and line feeds do not match")
            raw, w, at = ids.tobytes(), self.width, 0
            for word, e in zip(part, ends.tolist()):
                self.new[word] = raw[at * w:e * w]
                at = e + 1

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as bytes of ``width``-byte integers."""
        new, old = self.new, self.old
        new["\n"] = self.feed
        cut: list[list[str] | None] = []
        out: list[bytes | None] = []
        need: dict[str, None] = {}
        for t in texts:
            words = t.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if t and "\0" not in t else None
            cut.append(words)
            got = list(map(new.get, words)) if words else []
            if words and None not in got:
                out.append(b"".join(got))
                continue
            out.append(None if t else b"")
            for word, ids in zip(words or (), got):
                if ids is None and word not in need and word not in new:
                    if (kept := old.pop(word, None)) is not None:
                        new[word] = kept
                    else:
                        need[word] = None
        self._learn([x for x in need if self._plain(x)])
        for n, (t, words) in enumerate(zip(texts, cut)):
            if out[n] is None:
                got = list(map(new.get, words or [""]))
                out[n] = self._whole(t) if None in got else b"".join(got)
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return out

    def _plain(self, word: str) -> bool:
        """A word of characters that are not white space, behind at most one space."""
        body = word[1:] if word[:1] == " " else word
        return body.split() == [body] and not any(s in word for s in self.special)


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker (functions are unpickled anew for each task)."""
    return sys.modules.setdefault("strata_worker_state", types.ModuleType("strata_worker_state")).__dict__


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text", file_ids: int = 8_000_000) -> DataFrame:
    """Encode ``docs`` in ascending doc_id order into token files under ``folder`` (a shared folder); returns the
    manifest (file, first document's place, n_docs, n_ids, ``start`` = ids in all files before).

    Null texts are empty, each document ends with ``end_id``.  Null ids come first; equal ids are ordered by text
    digest, so repeated rows stay.  An empty table gives an empty manifest and no file."""
    x = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("k"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    order = ["k", F.xxhash64("t")]
    x = x.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches):
        state = worker_state()
        enc = state.get(("bpe", tokenizer)) or state.setdefault(("bpe", tokenizer), WordEncoder(tokenizer))
        fs, root = pafs.FileSystem.from_uri(folder)
        pid, seq = TaskContext.get().partitionId(), 0
        tail = np.array([end_id], enc.kind).tobytes()
        keys, lengths, ids, size = [], [], [], 0

        def flush():
            name = f"{root}/part-{pid:06d}-{seq:05d}-{uuid.uuid4().hex}.eft"
            with fs.open_output_stream(name) as f:
                f.write(pack(keys, lengths, ids, enc.width))
            return pa.RecordBatch.from_pylist([{"file": name, "pid": pid, "seq": seq, "n_docs": len(keys),
                                                "n_ids": size}], pa.schema([("file", pa.string()), ("pid", pa.int32()),
                                                                            ("seq", pa.int32()), ("n_docs", pa.int64()),
                                                                            ("n_ids", pa.int64())]))

        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                for key, raw in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                    n = len(raw) // enc.width + 1
                    if keys and size + n > file_ids:
                        yield flush()
                        seq += 1
                        keys, lengths, ids, size = [], [], [], 0
                    keys.append(NULL_ID if key is None else key)
                    lengths.append(n)
                    ids.append(raw + tail)
                    size += n
        if keys:
            yield flush()

    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    x.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    m = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("pid", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return m.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("bigint"))


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32`` (crc32 of the ids as unsigned 32-bit
    little-endian integers)."""
    def read(batches):
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(row["file"]) as f:
                    t = TokenFile(f)
                    for a in range(0, t.n, 2000):
                        b = min(a + 2000, t.n)
                        at = t.boundaries(a, b + 1)
                        ids = t.ids(int(at[0]), int(at[-1])).astype("<u4")
                        crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(at[:-1] - at[0], at[1:] - at[0])]
                        yield pa.record_batch([pa.array(t.keys[a:b], mask=t.keys[a:b] == NULL_ID),
                                               pa.array(at[:-1] + row["start"]), pa.array(np.diff(at)),
                                               pa.array(crc, pa.int64())],
                                              names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = manifest.count()
    spread = manifest.repartition(max(1, min(n, 10_000)), "file")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder, as a URI."""
    base = ensure_checkpoint_dir(spark)
    base = base if "://" in base or base.startswith("file:") else f"file://{base}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
