"""Removal of repeated 100-byte strings with suffix arrays sorted by the deep-shallow method.

A byte is removed when a ``size``-byte string that covers it also starts earlier (in a document that comes before in
(doc_id, text hash) order, or earlier in the same document).  Strings are judged on the input, over UTF-8 bytes, inside
documents.

Only places that can matter are sorted.  Every ``size``-byte window has an anchor: the leftmost of its ``GRAM``-byte
grams with the smallest hash.  Equal windows have equal anchors, and about one position in 39 is an anchor.

1. Every anchor stands for up to two halves: its windows that begin at most 38 bytes before it, which all hold the 62
   bytes from the anchor on, and those that begin earlier, which all hold the 63 bytes around it.  Halves meet by the
   hash of these bytes (their key), so a phrase that is shorter than that never gathers its occurrences in one place,
   however many documents hold it.  A half carries a digest of the bytes its windows can reach (its context).  One
   whose whole context occurred before has that context removed, on the equality of two 64-bit hashes; keys with
   several different contexts are taken on.  Map tasks combine equal contexts first, so a passage that a third of all
   documents share sends one half per task and key.
2. The contexts of those keys' first occurrences are cut from the texts and meet again by key.  Their suffixes from
   the anchor on, and the reversed prefixes before it, are sorted: multikey quicksort over 8-byte characters to a
   shallow depth, blind tries for the groups that still share their prefix.  The two suffix arrays with their common
   prefix lengths give each window an exact identity (class of its part before, class of its part behind the anchor);
   all but the earliest window of an identity are removed.
3. The spans meet their documents.

Texts travel only for documents that step 1 or 2 named (a bounded bitmap keeps most others out of the shuffle).  The
number of buckets, of anchors as of documents, follows the bytes of the input; a long text is hashed in pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ._text import PIECE, Hasher, mix64, spans, utf8
from .links import filtered, key_bitmap
from .tokens import scratch

SIZE, GRAM, SHALLOW = 100, 24, 32
FLUSH = 400_000  # halves that a map task holds before it sends them
BUCKET = 64 << 20  # text bytes a bucket
DOC = np.dtype([("doc_id", "<i8"), ("th", "<i8"), ("db", "<i4")])
ANCHOR = [("key", "<u8"), ("ctx", "<u8"), ("doc", "<u4"), ("pos", "<u4"), ("l", "u1"), ("r", "u1"), ("lo", "u1"),
          ("hi", "u1")]
NULL_ID = -(1 << 63)


# ---- anchors ---------------------------------------------------------------------------------------------------

def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive entries, by doubling."""
    m, have = x, 1
    while 2 * have <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:len(x) - w + 1], m[w - have:]) if w > have else m


def sides(size: int = SIZE, gram: int = GRAM) -> list[tuple[range, int, int]]:
    """Per half of an anchor: its offsets in the windows, and the bytes before and from the anchor that these reach."""
    reach = size - gram
    half = reach // 2
    return [(range(half + 1), half, size), (range(half + 1, reach + 1), reach, size - half - 1)]


def _window_anchors(data: np.ndarray, off: np.ndarray, hasher: Hasher, size: int, gram: int, piece: int):
    """Place of every anchor with the first and last start of the windows it is the anchor of; windows that cross
    documents are left out.  The bytes are taken in pieces that overlap by one window."""
    found = []
    for a in range(0, max(len(data) - size + 1, 0), piece):
        part = data[a:a + piece + size - 1]
        c = hasher.prefix(part)
        at = np.arange(len(part) - gram + 1)
        g = mix64(hasher.span(c, at, at + gram))
        key = (g >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
        best = (sliding_min(key, size - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64) + a
        start = np.arange(a, a + len(best))
        end = np.repeat(off[1:], np.diff(np.clip(off, a, a + len(best))))  # of the document that the window starts in
        inside = start + size <= end
        start, best = start[inside], best[inside]
        if len(start):
            first = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
            found.append((best[first], start[first], start[np.append(first[1:], len(best)) - 1]))
    if not found:
        return np.zeros((3, 0), np.int64)
    p, s, e = (np.concatenate(x) for x in zip(*found))
    new = np.append(True, p[1:] != p[:-1])  # an anchor may serve windows of two pieces
    first = np.flatnonzero(new)
    return p[first], s[first], e[np.append(first[1:], len(p)) - 1]


def anchors(data: np.ndarray, off: np.ndarray, hasher: Hasher, size: int = SIZE, gram: int = GRAM,
            piece: int = PIECE) -> dict:
    """Halves of the anchors of a batch of documents, see ``ANCHOR``; ``lo`` .. ``hi`` are the offsets of the anchor in
    the windows of the half, ``l`` and ``r`` the bytes of its context before and from the anchor."""
    p, s, e = _window_anchors(data, off, hasher, size, gram, piece)
    doc = np.searchsorted(off, p, side="right") - 1
    key, ctx = np.zeros((2, len(p)), np.uint64), np.zeros((2, len(p)), np.uint64)
    lo, hi, left, right = np.zeros((4, 2, len(p)), np.int64)
    for i, (offsets, before, behind) in enumerate(sides(size, gram)):
        lo[i], hi[i] = np.maximum(p - e, offsets[0]), np.minimum(p - s, offsets[-1])
        left[i], right[i] = np.minimum(p - off[doc], before), np.minimum(off[doc + 1] - p, behind)
    live = lo <= hi
    for a in range(0, len(data), piece):  # hashes again by pieces, wide enough for every context
        x, y = np.searchsorted(p, [a, a + piece])
        if x == y:
            continue
        base = max(a - size, 0)
        c = hasher.prefix(data[base:a + piece + size])
        for i, (offsets, _, _) in enumerate(sides(size, gram)):
            at = np.arange(x, y)[live[i, x:y]]
            q = p[at] - base
            l, r = left[i, at], right[i, at]
            core = hasher.span(c, q - offsets[0], q + (size - offsets[-1]))
            key[i, at] = mix64(core + np.uint64(i))
            ctx[i, at] = mix64(hasher.span(c, q - l, q + r) + (l * 1000 + r).astype(np.uint64))
    i, at = np.nonzero(live)
    return {"key": key[i, at], "ctx": ctx[i, at], "doc": doc[at].astype("<u4"), "pos": (p - off[doc])[at].astype("<u4"),
            "l": left[i, at].astype("u1"), "r": right[i, at].astype("u1"), "lo": lo[i, at].astype("u1"),
            "hi": hi[i, at].astype("u1")}


def pack(cols: dict, kinds: list) -> bytes:
    """Columns one after another behind their length (equal values of a column compress well)."""
    n = len(next(iter(cols.values())))
    return np.int64(n).tobytes() + b"".join(np.ascontiguousarray(cols[k], t).tobytes() for k, t in kinds)


def unpack(blobs: list[bytes], kinds: list) -> tuple[dict, np.ndarray]:
    """Columns of several packed blocks, and the number of each row's block."""
    parts: dict[str, list] = {k: [] for k, _ in kinds}
    sizes = []
    for b in blobs:
        n, at = int(np.frombuffer(b, "<i8", 1)[0]), 8
        sizes.append(n)
        for k, t in kinds:
            parts[k].append(np.frombuffer(b, t, n, at))
            at += n * np.dtype(t).itemsize
    cols = {k: np.concatenate(v) if v else np.zeros(0, dict(kinds)[k]) for k, v in parts.items()}
    return cols, np.repeat(np.arange(len(sizes)), sizes)


def first_of(*keys: np.ndarray, order: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Sort by ``keys`` then ``order``: the permutation, and for each sorted row the place of its group's first."""
    by = np.lexsort((*reversed(order), *reversed(keys)))
    new = np.ones(len(by), bool)
    if len(by):
        new[1:] = np.logical_or.reduce([k[by][1:] != k[by][:-1] for k in keys])
    return by, np.flatnonzero(new)[np.cumsum(new) - 1] if len(by) else np.zeros(0, np.int64)


def doc_order(docs: np.ndarray) -> np.ndarray:
    """Rank of every entry of a document table by (doc_id, th); equal documents share a rank."""
    by = np.lexsort((docs["th"], docs["doc_id"]))
    s = docs[by]
    new = np.ones(len(s), bool)
    new[1:] = (s["doc_id"][1:] != s["doc_id"][:-1]) | (s["th"][1:] != s["th"][:-1])
    rank = np.empty(len(s), np.int64)
    rank[by] = np.cumsum(new) - 1
    return rank


SPAN = [("doc", "<u4"), ("start", "<u4"), ("end", "<u4")]
PLACE = [("key", "<u8"), ("doc", "<u4"), ("pos", "<u4"), ("l", "u1"), ("r", "u1"), ("lo", "u1"), ("hi", "u1")]


def _pick(cols: dict, at, kinds) -> dict:
    return {k: cols[k][at] for k, _ in kinds}


def _with_docs(cols: dict, docs: np.ndarray, kinds: list, number: np.ndarray, buckets: int):
    """(bucket, document table, packed columns) per bucket ``number``; the table holds only the bucket's documents."""
    order = np.argsort(number, kind="stable")
    cut = np.searchsorted(number[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)):
        part = {k: cols[k][order[cut[b]:cut[b + 1]]] for k, _ in kinds}
        used, local = np.unique(part["doc"], return_inverse=True)
        part["doc"] = local.astype("<u4")
        yield int(b), docs[used].tobytes(), pack(part, kinds)


def _anchor_rows(docs: DataFrame, buckets: int, size: int, gram: int) -> DataFrame:
    """Step 1, map side: halves by key bucket (kind 0) and spans already certain inside the task (kind 1)."""
    def run(batches):
        hasher = Hasher()
        held, tables, n_docs, n = [], [], 0, 0

        def flush():
            cols = {k: np.concatenate([h[k] for h in held]) for k, _ in ANCHOR}
            table = np.concatenate(tables)
            rank = doc_order(table)[cols["doc"]]
            by, head = first_of(cols["key"], cols["ctx"], order=(rank, cols["pos"]))
            first = head == np.arange(len(by))
            again = by[~first & ((rank[by] != rank[by[head]]) | (cols["pos"][by] != cols["pos"][by[head]]))]
            heads = by[first]
            rows = [(b, 0, t, p) for b, t, p in _with_docs(
                _pick(cols, heads, ANCHOR), table, ANCHOR, (cols["key"][heads] % np.uint64(buckets)).astype(np.int64),
                buckets)]
            sp = {"doc": cols["doc"][again], "start": cols["pos"][again] - cols["l"][again],
                  "end": cols["pos"][again] + cols["r"][again]}
            rows += [(b, 1, t, p) for b, t, p in _with_docs(sp, table, SPAN, table["db"][sp["doc"]].astype(np.int64),
                                                            buckets)]
            return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                             pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())],
                            names=["bucket", "kind", "docs", "data"]).to_batches()

        for batch in batches:
            data, off = utf8(batch.column(1))
            ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            th, db = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for i, j in spans(off):
                a = anchors(data[off[i]:off[j]], off[i:j + 1] - off[i], hasher, size, gram)
                a["doc"] = a["doc"] + np.uint32(n_docs)
                table = np.zeros(j - i, DOC)
                table["doc_id"], table["th"], table["db"] = ids[i:j], th[i:j], db[i:j]
                held.append(a)
                tables.append(table)
                n_docs += j - i
                n += len(a["pos"])
                if n >= FLUSH:
                    yield from flush()
                    held, tables, n_docs, n = [], [], 0, 0
        if n:
            yield from flush()

    return docs.select("doc_id", "t", "th", "db").mapInArrow(run, "bucket int, kind int, docs binary, data binary")


def _meet(rows: DataFrame, buckets: int) -> DataFrame:
    """Step 1, reduce side: per document bucket ``db``, spans (kind 1) and places whose context is wanted (kind 0)."""
    def run(table: pa.Table) -> pa.Table:
        kind = np.array(table.column("kind").to_pylist())
        blobs, tabs = table.column("data").to_pylist(), table.column("docs").to_pylist()
        out = [(1, t, b) for k, t, b in zip(kind, tabs, blobs) if k == 1]
        ours = [i for i, k in enumerate(kind) if k == 0]
        if ours:
            cols, block = unpack([blobs[i] for i in ours], ANCHOR)
            parts = [np.frombuffer(tabs[i], DOC) for i in ours]
            docs = np.concatenate(parts)
            base = np.cumsum([0] + [len(p) for p in parts])[:-1]
            cols["doc"] = cols["doc"].astype(np.int64) + base[block]
            rank = doc_order(docs)[cols["doc"]]
            by, head = first_of(cols["key"], cols["ctx"], order=(rank, cols["pos"]))
            first = head == np.arange(len(by))
            again = by[~first & ((rank[by] != rank[by[head]]) | (cols["pos"][by] != cols["pos"][by[head]]))]
            pos = cols["pos"].astype(np.int64)
            sp = {"doc": cols["doc"][again], "start": pos[again] - cols["l"][again], "end": pos[again] + cols["r"][again]}
            heads = by[first]
            g = cols["key"][heads]  # sorted
            same = np.zeros(len(g) + 1, bool)
            same[1:-1] = g[1:] == g[:-1]
            heads = heads[same[1:] | same[:-1]]
            db = docs["db"].astype(np.int64)
            out += [(1, t, p) for _, t, p in _with_docs(sp, docs, SPAN, db[sp["doc"]], buckets)]
            out += [(0, t, p) for _, t, p in _with_docs(_pick(cols, heads, PLACE), docs, PLACE, db[cols["doc"][heads]],
                                                        buckets)]
        return _spans_table(out)

    return rows.groupBy("bucket").applyInArrow(run, "db int, kind int, ths array<bigint>, docs binary, data binary")


def _spans_table(out: list) -> pa.Table:
    tabs = [np.frombuffer(t, DOC) for _, t, _ in out]
    return pa.table([pa.array([int(t["db"][0]) for t in tabs], pa.int32()), pa.array([k for k, _, _ in out], pa.int32()),
                     pa.array([t["th"].tolist() for t in tabs], pa.list_(pa.int64())),
                     pa.array([t for _, t, _ in out], pa.binary()), pa.array([b for _, _, b in out], pa.binary())],
                    names=["db", "kind", "ths", "docs", "data"])


# ---- deep-shallow sorting --------------------------------------------------------------------------------------

class BlindTrie:
    """Patricia trie over equal-length strings that holds branching depths and branch bytes only: an insertion walks
    to some leaf without comparing, compares once with that leaf, and splits the edge at the common length."""

    def __init__(self, rows: list[bytes]):
        self.rows = rows
        self.same: dict[bytes, list[int]] = {}
        self.root = None
        for i, s in enumerate(rows):
            if s in self.same:
                self.same[s].append(i)
            else:
                self.same[s] = [i]
                self._insert(s)

    @staticmethod
    def common(a: bytes, b: bytes) -> int:
        """Length of the common prefix of two different strings."""
        lo, hi = 0, len(a)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if a[lo:mid] == b[lo:mid]:
                lo = mid
            else:
                hi = mid
        return lo

    def _insert(self, s: bytes) -> None:
        if self.root is None:
            self.root = s
            return
        node = self.root
        while not isinstance(node, bytes):
            depth, kids = node
            node = kids.get(s[depth]) or next(iter(kids.values()))
        d = self.common(s, node)
        parent, byte, at = None, 0, self.root
        while not isinstance(at, bytes) and at[0] < d:
            parent, byte = at, s[at[0]]
            at = at[1][byte]
        if not isinstance(at, bytes) and at[0] == d:
            at[1][s[d]] = s
            return
        split = (d, {node[d]: at, s[d]: s})
        if parent is None:
            self.root = split
        else:
            parent[1][byte] = split

    def order(self) -> list[int]:
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, bytes):
                out += self.same[node]
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def deep_shallow(rows: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """Order of the rows (n x m bytes) as strings.

    Shallow: multikey quicksort, one 8-byte character per level; a group that a level leaves with one row is done.
    Deep: the rows of each group that still agree are ordered by a blind trie."""
    n, m = rows.shape
    wide = -(-m // 8) * 8
    padded = np.zeros((n, wide), np.uint8)
    padded[:, :m] = rows
    chars = padded.view(">u8").astype(np.uint64)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # by place: start of the group that the place belongs to
    live = np.arange(n)  # places in groups of several rows
    for level in range(min(-(-shallow // 8), chars.shape[1])):
        if len(live) < 2:
            return order
        key = chars[order[live], level]
        by = np.lexsort((key, group[live]))
        order[live] = order[live][by]
        key, grp = key[by], group[live]
        new = np.ones(len(live), bool)
        new[1:] = (key[1:] != key[:-1]) | (grp[1:] != grp[:-1])
        group[live] = live[np.flatnonzero(new)[np.cumsum(new) - 1]]
        alone = new & np.append(new[1:], True)
        live = live[~alone]
    if len(live):
        heads = np.flatnonzero(np.append(True, group[live][1:] != group[live][:-1]))
        raw, skip = np.ascontiguousarray(rows[order[live], shallow:]).tobytes(), m - shallow
        ordered = order[live]
        for a, b in zip(heads.tolist(), np.append(heads[1:], len(live)).tolist()):
            if skip > 0:
                t = BlindTrie([raw[i * skip:(i + 1) * skip] for i in range(a, b)])
                ordered[a:b] = order[live[a:b]][t.order()]
        order[live] = ordered
    return order


def depth_classes(rows: np.ndarray, depths) -> np.ndarray:
    """For every depth, the class of each row by its first ``depth`` bytes (depths x n), from the sorted order and the
    common prefixes of neighbours."""
    order = deep_shallow(rows)
    s = rows[order]
    differ = s[1:] != s[:-1]
    lcp = np.where(differ.any(1), differ.argmax(1), rows.shape[1]) if len(s) > 1 else np.zeros(0, np.int64)
    out = np.zeros((len(depths), len(rows)), np.int32)
    for i, d in enumerate(depths):
        out[i, order[1:]] = np.cumsum(lcp < d)
    return out


def repeated_offsets(ctx: np.ndarray, lo, hi, when, side: int, size: int = SIZE,
                     gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset at which a context's window occurs in an earlier one (largest -1: nowhere).

    ``ctx``: the bytes before and from the anchor that the ``side`` reaches (:func:`sides`), zero where the document
    ends; ``lo`` .. ``hi``: the offsets of the windows to judge; ``when``: order of the contexts."""
    offsets, reach, _ = sides(size, gram)[side]
    behind = depth_classes(ctx[:, reach:], [size - o for o in offsets])
    before = depth_classes(ctx[:, :reach][:, ::-1], offsets)
    least, most = np.full(len(ctx), size), np.full(len(ctx), -1)
    for i, o in enumerate(offsets):
        at = np.flatnonzero((lo <= o) & (o <= hi))
        if len(at) < 2:
            continue
        key = behind[i, at].astype(np.int64) * len(ctx) + before[i, at]
        by, head = first_of(key, order=(when[at],))
        dup = at[by[when[at[by]] != when[at[by[head]]]]]
        least[dup] = np.minimum(least[dup], o)
        most[dup] = o
    return least, most


# ---- contexts and spans ----------------------------------------------------------------------------------------

def _doc_index(table: pa.Table) -> dict:
    ids = table.column("doc_id").to_pylist()
    return {(NULL_ID if d is None else d, t): i for i, (d, t) in enumerate(zip(ids, table.column("th").to_pylist()))}


def _contexts(docs: DataFrame, places: DataFrame, buckets: int, size: int, gram: int) -> DataFrame:
    """Step 2, map side: the wanted contexts, cut from their texts, by side and key bucket."""
    halves = sides(size, gram)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            index = _doc_index(right)
            data, off = utf8(right.column("t"))
            padded = np.concatenate([np.zeros(size, np.uint8), data, np.zeros(size, np.uint8)])
            for tab, blob in zip(left.column("docs").to_pylist(), left.column("data").to_pylist()):
                cols, _ = unpack([blob], PLACE)
                table = np.frombuffer(tab, DOC)
                where = np.array([index[(d, t)] for d, t in zip(table["doc_id"].tolist(), table["th"].tolist())])
                for side, (offsets, before, behind) in enumerate(halves):
                    ours = np.flatnonzero((offsets[0] <= cols["lo"]) & (cols["lo"] <= offsets[-1]))
                    far = np.arange(-before, behind)
                    for a in range(0, len(ours), 50_000):
                        part = {k: v[ours[a:a + 50_000]] for k, v in cols.items()}
                        at = off[where[part["doc"]]] + part["pos"] + size
                        ctx = padded[at[:, None] + far]
                        ctx[(far < -part["l"].astype(int)[:, None]) | (far >= part["r"].astype(int)[:, None])] = 0
                        part["i"] = np.arange(len(at), dtype="<u4")
                        number = (part["key"] % np.uint64(buckets)).astype(np.int64)
                        kinds = PLACE + [("i", "<u4")]
                        for b, t, p in _with_docs(part, table, kinds, number, buckets):
                            mine = unpack([p], kinds)[0]["i"]
                            rows.append((b, side, t, p, ctx[mine].tobytes()))
        return pa.table([*(pa.array([r[i] for r in rows], pa.int32()) for i in (0, 1)),
                         *(pa.array([r[i] for r in rows], pa.binary()) for i in (2, 3, 4))],
                        names=["bucket", "side", "docs", "data", "ctx"])

    left = places.select(F.col("db").alias("pdb"), "docs", "data")
    return left.groupBy("pdb").cogroup(docs.select("db", "doc_id", "th", "t").groupBy("db")).applyInArrow(
        run, "bucket int, side int, docs binary, data binary, ctx binary")


def _judge(contexts: DataFrame, buckets: int, size: int, gram: int) -> DataFrame:
    """Step 2, reduce side: spans of the contexts' repeated windows."""
    kinds = PLACE + [("i", "<u4")]

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side")[0].as_py()
        _, before, behind = sides(size, gram)[side]
        cols, block = unpack(table.column("data").to_pylist(), kinds)
        parts = [np.frombuffer(t, DOC) for t in table.column("docs").to_pylist()]
        docs = np.concatenate(parts)
        cols["doc"] = cols["doc"].astype(np.int64) + np.cumsum([0] + [len(p) for p in parts])[:-1][block]
        ctx = np.frombuffer(b"".join(table.column("ctx").to_pylist()), np.uint8).reshape(-1, before + behind)
        rank = doc_order(docs)[cols["doc"]]
        by, head = first_of(rank, cols["pos"], order=())
        when = np.empty(len(by), np.int64)
        when[by] = head
        least, most = repeated_offsets(ctx, cols["lo"].astype(int), cols["hi"].astype(int), when, side, size, gram)
        at = np.flatnonzero(most >= 0)
        pos = cols["pos"].astype(np.int64)
        sp = {"doc": cols["doc"][at], "start": pos[at] - most[at], "end": pos[at] + size - least[at]}
        return _spans_table([(1, t, p) for _, t, p in _with_docs(sp, docs, SPAN, docs["db"][sp["doc"]].astype(np.int64),
                                                                 buckets)])

    return contexts.groupBy("bucket", "side").applyInArrow(run, "db int, kind int, ths array<bigint>, docs binary, data binary")


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of [start, end) ranges as maximal runs (ranges that touch are one run)."""
    by = np.argsort(start, kind="stable")
    s, e = start[by], np.maximum.accumulate(end[by]) if len(by) else end[by]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:], len(s)) - 1] if len(s) else e


def _apply(docs: DataFrame, spans_of: DataFrame, extra: list, with_text: bool) -> DataFrame:
    """Step 3: cut the spans out of their documents."""
    cols = ["doc_id", "th", *extra]
    schema = docs.select(*cols, F.lit(0).cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
                         F.lit(0).cast("bigint").alias("n_spans"), F.lit("").alias("kept_sha256"),
                         *([F.lit("").alias("kept")] if with_text else [])).schema

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
        out: dict[str, list] = {k: [] for k in names}
        kept_all = []
        found: dict[tuple, list] = {}
        for tab, blob in zip(left.column("docs").to_pylist(), left.column("data").to_pylist()):
            cols_, _ = unpack([blob], SPAN)
            table = np.frombuffer(tab, DOC)
            order = np.argsort(cols_["doc"], kind="stable")
            cut = np.searchsorted(cols_["doc"][order], np.arange(len(table) + 1))
            for i, (d, t) in enumerate(zip(table["doc_id"].tolist(), table["th"].tolist())):
                at = order[cut[i]:cut[i + 1]]
                found.setdefault((d, t), []).append((cols_["start"][at], cols_["end"][at]))
        data, off = utf8(right.column("t"))
        ids, ths = right.column("doc_id").to_pylist(), right.column("th").to_pylist()
        for i in range(right.num_rows):
            text = data[off[i]:off[i + 1]]
            got = found.get((NULL_ID if ids[i] is None else ids[i], ths[i]))
            n_spans = 0
            if got:
                s, e = merged(np.concatenate([x[0] for x in got]).astype(np.int64),
                              np.concatenate([x[1] for x in got]).astype(np.int64))
                n_spans = len(s)
                flag = np.zeros(len(text) + 1, np.int8)
                flag[s] += 1
                flag[e] -= 1
                kept = text[np.cumsum(flag[:-1], dtype=np.int8) == 0].tobytes()
            else:
                kept = text.tobytes()
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(kept))
            out["n_spans"].append(n_spans)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_all.append(kept.decode("utf-8", "ignore"))
        arrays = [right.column(c) for c in cols] + [pa.array(out[k], pa.string() if k == "kept_sha256" else pa.int64())
                                                    for k in names]
        if with_text:
            arrays.append(pa.array(kept_all, pa.string()))
        return pa.table(arrays, names=cols + names + (["kept"] if with_text else []))

    left = spans_of.select(F.col("db").alias("sdb"), "docs", "data")
    return left.groupBy("sdb").cogroup(docs.groupBy("db")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, gram: int = GRAM,
                   keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs), ``kept_sha256``, the ``keep``
    columns, and with ``with_text`` the kept text in ``kept`` (a character that lost a byte goes as a whole).

    Null texts are empty; texts below ``size`` bytes have no string to remove.  Documents are ordered by (doc_id, text
    hash), null ids first.  Rows with equal id and text count as the same document (each is returned with the same
    result); equal texts under different ids are repeats.  An empty table gives no rows.  Extra columns of ``docs`` may have
    any name; one in ``keep`` that is also a name of the result raises ValueError."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    keep = keep or []
    taken = {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])}
    names = [c for c in keep if c.lower() in taken]
    if names or len({c.lower() for c in keep}) < len(keep):
        raise ValueError(f"columns to keep clash with the result: {names or keep}")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    n_bytes = docs.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // BUCKET))
    x = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("t"), F.xxhash64(text).alias("th"),
                    *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    x = x.withColumn("db", F.pmod(F.xxhash64("doc_id", "th"), F.lit(buckets)).cast("int"))
    extra = [f"k{i}" for i in range(len(keep))]

    place = scratch(spark, "anchors")
    _meet(_anchor_rows(x, buckets, size, gram), buckets).write.parquet(place)
    met = spark.read.parquet(place)
    wanted = met.filter("kind = 0")
    hashed = x.withColumn("hh", F.xxhash64("th"))
    some = filtered(hashed.select("doc_id", "t", "th", "db", "hh"), "hh",
                    key_bitmap(wanted.select(F.explode("ths").alias("th")).distinct(), "th"))
    judged = scratch(spark, "spans")
    _judge(_contexts(some, wanted, buckets, size, gram), buckets, size, gram).write.parquet(judged)
    spans_of = met.filter("kind = 1").select("db", "ths", "docs", "data").unionByName(
        spark.read.parquet(judged).select("db", "ths", "docs", "data"))
    bits = key_bitmap(spans_of.select(F.explode("ths").alias("th")).distinct(), "th")
    touched = filtered(hashed, "hh", bits).drop("hh")
    untouched = filtered(hashed, "hh", bits, invert=True)
    n = F.octet_length("t").cast("bigint")
    zero = F.lit(0).cast("bigint")
    rest = untouched.select("doc_id", "th", *extra, n.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                            F.sha2(F.col("t").cast("binary"), 256).alias("kept_sha256"),
                            *([F.col("t").alias("kept")] if with_text else []))
    out = _apply(touched, spans_of, extra, with_text).unionByName(rest)
    for i, c in enumerate(keep):
        out = out.withColumnRenamed(f"k{i}", c) if c != "th" else out.drop("th").withColumnRenamed(f"k{i}", c)
    return out
