"""Benchmark decontamination: a prefix-filtered join of documents with item windows.

An item's windows are its runs of ``window`` consecutive words (an item of fewer words, but not none, is one window).
A document contains a window only if it holds all its words in order, so one word of the window - its necessary prefix
under containment 1 - is enough to find it.  Words are ordered by rarity over the whole corpus and each window is
filed under its rarest word.  A document word that is filed proposes a place: it must lie far enough from both ends of
the document (positional and length bounds), then the window's other words are compared from rare to frequent, and
what is left is verified byte by byte.

The windows are taken in blocks of at most ``block_windows``; only the ids and words of one block are sent to the
executors at a time, and every document is matched against every block.  Items stay in a table: a document keeps the ids
of the windows it holds, each distinct set of ids meets the (window, item) table once, and the documents take the items
of their set.  So a window that a third of the items share is one id in the tasks and on the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ._text import Hasher, lower_bytes, rebuilt, spans, utf8, words


def item_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item`` (id as string), ``win`` (words joined by a space): one row per item and distinct window of it."""
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    x = items.select(F.col(f"`{id_col}`").cast("string").alias("item"),
                     F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0)).alias("w"))
    x = x.filter(F.col("item").isNotNull() & (F.size("w") > 0))
    last = F.greatest(F.size("w") - window, F.lit(0))
    x = x.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return x.select("item", F.array_join(F.slice("w", F.col("at") + 1, F.lit(window)), " ").alias("win")).distinct()


def _word_hash(texts: list[bytes]) -> list[np.ndarray]:
    data = b"\n".join(texts)
    off = np.cumsum([0] + [len(t) + 1 for t in texts])
    off[-1] = max(off[-1] - 1, 0) if texts else 0
    buf = np.frombuffer(data, np.uint8)
    _, _, h, first = words(buf, np.minimum(off, len(buf)), Hasher())
    return [h[a:b] for a, b in zip(first[:-1], first[1:])]


class Windows:
    """A block of windows filed under their rarest word."""

    def __init__(self, rows: list[tuple[int, str]], counts: dict[int, int]):
        self.ids = [i for i, _ in rows]
        self.text = [w.encode() for _, w in rows]
        hashes = _word_hash(self.text)
        self.size = np.array([len(h) for h in hashes], np.int64)
        width = int(self.size.max(initial=0))
        self.words = np.zeros((len(rows), width), np.uint64)
        self.order = np.zeros((len(rows), width), np.int64)  # word places from rare to frequent
        for i, h in enumerate(hashes):
            self.words[i, :len(h)] = h
            by = sorted(range(len(h)), key=lambda j: (counts.get(int(h[j]), 0), int(h[j]), j))
            self.order[i, :len(h)] = by
        rare = self.words[np.arange(len(rows)), self.order[:, 0]] if width else np.zeros(0, np.uint64)
        by = np.argsort(rare, kind="stable")
        self.keys, self.first = np.unique(rare[by], return_index=True)
        self.first = np.append(self.first, len(by))
        self.filed = by

    def candidates(self, h: np.ndarray, room: int = 1 << 20):
        """Pieces of (start word, window) pairs proposed by filed words: at most ``room`` pairs and one word's windows
        a piece, however many windows lie under a frequent word."""
        if not len(self.keys) or not len(h):
            return
        k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[k] == h)
        low, n = self.first[k[at]], self.first[k[at] + 1] - self.first[k[at]]
        piece = (np.cumsum(n) - n) // room
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(at)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            m = n[a:b]
            skip = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            win = self.filed[np.repeat(low[a:b], m) + skip]
            yield np.repeat(at[a:b], m) - self.order[win, 0], win

    def match(self, h, first, doc_of, room: int = 1 << 20):
        """(start word, window) of all windows whose word hashes occur inside one document."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for start, win in self.candidates(h, room):
            doc = doc_of[start + self.order[win, 0]]
            ok = (start >= first[doc]) & (start + self.size[win] <= first[doc + 1])
            start, win = start[ok], win[ok]
            for j in range(1, self.words.shape[1]):
                if not len(start):
                    break
                live = j < self.size[win]
                place = self.order[win, j]
                ok = ~live | (h[np.where(live, start + place, 0)] == self.words[win, place])
                start, win = start[ok], win[ok]
            out.append((start, win))
        return np.concatenate([s for s, _ in out]), np.concatenate([w for _, w in out])


def corpus_counts(docs: DataFrame, vocab: np.ndarray) -> DataFrame:
    """How often each vocabulary word (64-bit hash) occurs in the column ``t`` of all documents."""
    held = docs.sparkSession.sparkContext.broadcast(np.unique(vocab))

    def count(batches):
        v, hasher = held.value, Hasher()
        total = np.zeros(len(v), np.int64)
        for batch in batches:
            data, off = utf8(batch.column(0))
            for i, j in spans(off):
                h = words(data[off[i]:off[j]], off[i:j + 1] - off[i], hasher)[2]
                k = np.minimum(np.searchsorted(v, h), len(v) - 1)
                total += np.bincount(k[v[k] == h], minlength=len(v))
        yield pa.record_batch([pa.array(v.view(np.int64)), pa.array(total)], names=["h", "n"])

    return docs.select("t").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_windows: int = 100_000,
                  keep: list[str] | None = None, item_form: str = "list") -> DataFrame:
    """Every document with ``n_words`` and ``spans`` (the maximal hit word ranges [start, end)); ``keep`` names further
    columns to carry.  ``item_form`` says how the items with occurring windows are given: ``list`` as ``items`` (sorted
    ids, as strings), ``digest`` as ``n_items`` and ``items_sha256`` (of the sorted ids joined by commas; made once per
    distinct set of windows, so no list travels with the documents), ``none`` not at all.

    Words are the runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters.  Null and empty texts have no words.
    Items without words match nothing, rows without an item id are left out, repeated items count once.  Repeated
    documents stay as rows of their own.  Empty items leave every document clean.  Other columns of ``docs`` and
    ``items`` may have any name; one in ``keep`` that is also a name of the result raises ValueError."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    keep = keep or []
    given = {"list": ["items"], "digest": ["n_items", "items_sha256"], "none": []}[item_form]
    names = [id_col, *keep, "n_words", "spans", *given]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"columns to keep clash with the result: {names}")
    x = docs.select(F.col(f"`{id_col}`").alias("d"), F.col(f"`{text_col}`").alias("t"),
                    *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    pairs = item_windows(items, window, item_id, item_text).checkpoint(eager=True)
    wins = pairs.select("win").distinct().withColumn("wid", F.monotonically_increasing_id()).checkpoint(eager=True)
    blocks = max(1, -(-wins.count() // block_windows))
    x = x.select("d", "t", *[f"k{i}" for i in range(len(keep))], F.lit(0).cast("bigint").alias("n_words"),
                 F.lit(None).cast("array<bigint>").alias("s"), F.lit(None).cast("array<bigint>").alias("w"))
    for b in range(blocks):
        # one block of windows: at most about block_windows short rows, by hash
        rows = [(r["wid"], r["win"]) for r in
                wins.filter(F.pmod(F.xxhash64("win"), F.lit(blocks)) == b).orderBy("win").collect()]
        vocab = np.unique(np.concatenate(_word_hash([w.encode() for _, w in rows]) or [np.zeros(0, np.uint64)]))
        counts = {}
        if len(vocab):
            counts = {r["h"] & ((1 << 64) - 1): r["n"] for r in corpus_counts(x, vocab).collect()}
        held = spark.sparkContext.broadcast(vars(Windows(rows, counts)))
        more = b + 1 < blocks  # another block needs the texts again
        x = x.mapInArrow(_matcher(held, more), x.schema if more else x.drop("t").schema)
        if more:
            x = x.checkpoint(eager=True)
    if given:
        x = _with_items(x, wins, pairs, item_form)
    ranges = F.transform(F.filter("s", lambda v, i: i % 2 == 0), lambda v, i: F.struct(
        v.alias("start"), F.get("s", 2 * i + 1).alias("end")))
    return x.select(F.col("d").alias(id_col), *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_words",
                    ranges.alias("spans"), *given)


def _with_items(x: DataFrame, wins: DataFrame, pairs: DataFrame, item_form: str) -> DataFrame:
    """``x`` with the items of its window ids ``w``: looked up once per distinct set of ids."""
    x = x.checkpoint(eager=True)
    of = pairs.join(wins, "win").select("wid", "item")
    sets = x.filter(F.size("w") > 0).select("w").distinct()
    found = (sets.select("w", F.explode("w").alias("wid")).join(of, "wid").select("w", "item").distinct()
             .groupBy("w").agg(F.array_sort(F.collect_list("item")).alias("items")))
    if item_form == "digest":
        found = found.select("w", F.size("items").cast("bigint").alias("n_items"),
                             F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
        blank = {"n_items": F.lit(0).cast("bigint"), "items_sha256": F.sha2(F.lit(""), 256)}
    else:
        blank = {"items": F.array().cast("array<string>")}
    # ids are not negative: a document without hits gets a key that no set has, spread over the tasks
    key = F.when(F.size("w") > 0, F.col("w")).otherwise(F.array(-1 - F.pmod(F.xxhash64("d"), F.lit(1 << 16))))
    out = x.withColumn("w", key).join(found, "w", "left")
    return out.withColumns({n: F.coalesce(n, v) for n, v in blank.items()})


def _matcher(held, with_text: bool):
    def run(batches):
        wins, hasher = rebuilt(Windows, held.value), Hasher()
        for batch in batches:
            data, off = utf8(batch.column(1))
            n_words, found, held_ids = [], [], []
            old_s = batch.column(batch.schema.get_field_index("s")).to_pylist()
            old_w = batch.column(batch.schema.get_field_index("w")).to_pylist()
            for i, j in spans(off):
                part = data[off[i]:off[j]]
                s, e, h, first = words(part, off[i:j + 1] - off[i], hasher)
                doc_of = np.repeat(np.arange(j - i), np.diff(first))
                start, win = wins.match(h, first, doc_of)
                hits = [set() for _ in range(j - i)]
                of = [set() for _ in range(j - i)]
                low = lower_bytes(part) if len(start) else part
                for a, w in zip(start.tolist(), win.tolist()):
                    size = int(wins.size[w])
                    text = b" ".join(low[p:q].tobytes() for p, q in zip(s[a:a + size], e[a:a + size]))
                    if text == wins.text[w]:
                        d = int(doc_of[a])
                        hits[d].add((a - int(first[d]), a - int(first[d]) + size))
                        of[d].add(wins.ids[w])
                for d in range(j - i):
                    flat = old_s[i + d] or []
                    hits[d].update(zip(flat[::2], flat[1::2]))
                    of[d].update(old_w[i + d] or [])
                    found.append([x for span in merge(hits[d]) for x in span])
                    held_ids.append(sorted(of[d]))
                n_words += np.diff(first).tolist()
            cols = {f.name: c for f, c in zip(batch.schema, batch.columns)}
            cols |= {"n_words": pa.array(n_words, pa.int64()), "s": pa.array(found, pa.list_(pa.int64())),
                     "w": pa.array(held_ids, pa.list_(pa.int64()))}
            if not with_text:
                del cols["t"]
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    return run


def merge(ranges) -> list[tuple[int, int]]:
    """Union of [start, end) ranges as maximal disjoint ranges."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The per-document counts of :func:`decontaminate`, from either form of its items."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    if "items" in found.columns:
        found = found.withColumns({"n_items": F.size("items").cast("bigint"),
                                   "items_sha256": F.sha2(F.array_join("items", ","), 256)})
    return found.select(id_col, "n_words", n_hit.alias("n_hit"), "n_items", "items_sha256",
                        (n_hit > 0).alias("contaminated"))
