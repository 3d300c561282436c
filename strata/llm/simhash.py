"""SimHash near-duplicates by a binary-trie self-join.

A document's fingerprint has bit b set if bit b is set in over half of the 64-bit hashes of its word shingles.  Equal
fingerprints are one entry.  Two entries link when they differ in at most ``budget`` bits.

The bits are cut into ``budget + 1`` runs, so a linked pair agrees in one of them at least.  For each run there is one
trie over all entries, whose bits are rotated so that the run comes first; a traversal starts at the pairs (x, x) of
nodes below that run.  From a pair of nodes it goes to the pairs of their children, adds one to the differing bits where
the children differ, and drops the pair when the budget is exceeded; pairs of small nodes are compared directly.

Entries travel by the run's value, once per trie.  A node with more than ``limit`` entries is not gathered: its pairs of
descendants, pruned in the same way, are traversed in a table of counts first, level by level, until each pair is small
enough for one task.  A task gives back only links that join components, so a group of n near copies costs fewer than n
rows per pair of nodes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ._text import lower_bytes, pieces, utf8
from .links import components

BITS, SHINGLE, BUDGET, SEED = 64, 4, 4, 42
LEAF, CHUNK, STEP = 16, 1 << 18, 4
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


# ---- fingerprints ----------------------------------------------------------------------------------------------

def joined_words(data: np.ndarray, offsets: np.ndarray):
    """(bytes, start, end, first): the words of every document, lower-cased, one space between two; each word's range
    in these bytes, and the index of each document's first word (n + 1 entries)."""
    inside = ~_BLANK[data]
    head = np.zeros(len(data) + 1, bool)
    head[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | head[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | head[1:-1]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # the first blank behind a word
    text = lower_bytes(data[keep])
    text[~inside[keep]] = 0x20
    at = np.cumsum(keep, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    s, e = np.flatnonzero(start), np.flatnonzero(last)
    return text, at[s] - 1, at[e], np.searchsorted(s, offsets)


def shingle_hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, k: int, whole: bool = True):
    """XXH64 of every document's shingles, and each document's number of them.  A document of 1 .. k-1 words is one
    shingle, unless ``whole`` is off (the text goes on)."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, ((n > 0) & whole).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[:-1][doc]
    a, b = start[at], end[np.minimum(at + k, first[1:][doc]) - 1]
    raw = text.tobytes()
    hashed = (xxhash.xxh64_intdigest(raw[i:j], SEED) for i, j in zip(a.tolist(), b.tolist()))
    return np.fromiter(hashed, np.uint64, len(a)), count


def bit_counts(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many of each document's hashes have each bit set (documents x 64)."""
    out = np.zeros((len(count), BITS), np.int64)
    live = np.flatnonzero(count)
    if len(live):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out[live] = np.add.reduceat(bits, (np.cumsum(count) - count)[live], axis=0, dtype=np.int64)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed bigint); ``docs`` has doc_id and t.  A long text is taken in pieces, each
    of which begins with the last words of the one before."""
    def run(batches):
        for batch in batches:
            data, off = utf8(batch.column(1))
            tail, ones, total = np.zeros(0, np.uint8), np.zeros((1, BITS), np.int64), 0
            for i, j, part, o, more in pieces(data, off, _BLANK):
                long = more or total or len(tail)
                if long:
                    part = np.concatenate([tail, part])
                    o = np.array([0, len(part)])
                text, s, e, first = joined_words(part, o)
                h, count = shingle_hashes(text, s, e, first, shingle, whole=not more and not total)
                set_bits = bit_counts(h, count)
                if long:
                    ones, total = ones + set_bits, total + int(count[0])
                    if more:
                        if shingle > 1 and len(s):
                            tail = np.append(text[s[-(shingle - 1):][0]:e[-1]], np.uint8(0x20))
                        continue
                    set_bits, count = ones, np.array([total])
                    tail, ones, total = np.zeros(0, np.uint8), np.zeros((1, BITS), np.int64), 0
                fp = np.packbits(2 * set_bits > count[:, None], axis=1, bitorder="little").view("<i8").ravel()
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id bigint, fp bigint")


# ---- trie self-join --------------------------------------------------------------------------------------------

def trie_pairs(value: np.ndarray, nodes, depth: int, budget: int):
    """Index pairs (i, j) whose values differ in at most ``budget`` bits, as arrays, from pairs of nodes at ``depth``.

    ``value`` (uint64) is sorted inside every node.  ``nodes``: arrays a0, a1, b0, b1, diff; a node is the range
    [a0, a1) of values that share their first ``depth`` bits, ``diff`` the differing bits of the two prefixes.  A pair of
    a node with itself has both ranges equal and gives each pair once.  Frontiers are taken ``CHUNK`` node pairs at a
    time, the deepest first, so memory stays bounded."""
    ones: dict[int, np.ndarray] = {}
    todo = [(depth, *nodes)]
    while todo:
        depth, a0, a1, b0, b1, diff = todo.pop()
        if len(a0) > CHUNK:
            half = len(a0) // 2
            todo += [(depth, *(x[half:] for x in (a0, a1, b0, b1, diff))), (depth, *(x[:half] for x in (a0, a1, b0, b1, diff)))]
            continue
        small = ((a1 - a0) * (b1 - b0) <= LEAF) | (depth == BITS)
        if small.any():
            p0, p1, q0, q1 = (x[small] for x in (a0, a1, b0, b1))
            size = (p1 - p0) * (q1 - q0)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            width = np.repeat(q1 - q0, size)
            i, j = np.repeat(p0, size) + at // width, np.repeat(q0, size) + at % width
            near = np.bitwise_count(value[i] ^ value[j]) <= budget
            near &= (i < j) | np.repeat(p0 != q0, size)
            if near.any():
                yield i[near], j[near]
        if small.all():
            continue
        a0, a1, b0, b1, diff = (x[~small] for x in (a0, a1, b0, b1, diff))
        if depth not in ones:
            bit = (value >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        c = ones[depth]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])  # children: [a0, am) and [am, a1)
        other = a0 != b0
        kids = [(a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1),
                tuple(x[other] for x in (am, a1, b0, bm, diff + 1))]
        a0, a1, b0, b1, diff = (np.concatenate(x) for x in zip(*kids))
        live = (a0 < a1) & (b0 < b1) & (diff <= budget)
        if live.any():
            todo.append((depth + 1, *(x[live] for x in (a0, a1, b0, b1, diff))))


def joining(n: int, pairs) -> tuple[np.ndarray, np.ndarray]:
    """Of chunks of index pairs, those that join components of 0 .. n-1 (a spanning forest)."""
    home = np.arange(n)
    a, b = [], []
    for i, j in pairs:
        while True:
            x, y = home[i], home[j]
            apart = x != y
            if not apart.any():
                break
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            high, low = np.maximum(x, y), np.minimum(x, y)
            order = np.lexsort((low, high))  # each component goes below its smallest neighbour
            one = order[np.concatenate([[True], np.diff(high[order]) > 0])]
            home[high[one]] = low[one]
            a.append(i[one])
            b.append(j[one])
            while (home != home[home]).any():
                home = home[home]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _runs(budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of the ``budget + 1`` runs."""
    cut = [BITS * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _rotated(c: Column, by: Column) -> Column:
    """The 64 bits of ``c`` turned left by ``by``."""
    left = F.call_function("shiftleft", c, by)
    return left.bitwiseOR(F.when(by == 0, F.lit(0).cast("bigint")).otherwise(
        F.call_function("shiftrightunsigned", c, F.lit(BITS) - by)))


def _prefix(c: Column, depth: Column) -> Column:
    """The first ``depth`` bits (1 .. 64) of ``c``."""
    return F.call_function("shiftrightunsigned", c, F.lit(BITS) - depth)


def node_pairs(entries: DataFrame, budget: int, limit: int) -> DataFrame | None:
    """Pairs of nodes ``trie, depth, a, b, diff`` of at most ``limit`` entries together, instead of the nodes below the
    first run that hold more; None if there is none.  Only counts per node are joined."""
    count = entries.groupBy("trie", F.col("width").alias("depth"), F.col("node").alias("a")).agg(F.count(F.lit(1)).alias("na"))
    hot = (count.filter(F.col("na") > limit).select("trie", "depth", "a", F.col("a").alias("b"), F.lit(0).alias("diff"), "na",
                                                    F.col("na").alias("nb")).checkpoint(eager=True))
    done, level = None, 0
    while hot.count():
        nodes = hot.select("trie", F.col("a").alias("n")).unionByName(hot.select("trie", F.col("b").alias("n"))).distinct()
        depth = F.least(F.col("width") + STEP * level, F.lit(BITS))
        deeper = F.least(F.col("depth") + STEP, F.lit(BITS))
        at = entries.select("trie", "value", depth.alias("depth"), _prefix(F.col("value"), depth).alias("n"))
        kids = (at.join(nodes, ["trie", "n"]).groupBy("trie", "depth", "n", _prefix(F.col("value"), deeper).alias("kid"))
                .agg(F.count(F.lit(1)).alias("size")).checkpoint(eager=True))
        level += 1
        side = lambda name: kids.select("trie", "depth", F.col("n").alias(name), F.col("kid").alias(f"k{name}"),
                                        F.col("size").alias(f"s{name}"))
        low = F.col("ka").bitwiseXOR(F.col("kb")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), deeper - F.col("depth")) - 1)
        x = (hot.join(side("a"), ["trie", "depth", "a"]).join(side("b"), ["trie", "depth", "b"])
             .filter((F.col("a") != F.col("b")) | (F.col("ka") <= F.col("kb")))
             .select("trie", deeper.alias("depth"), F.col("ka").alias("a"), F.col("kb").alias("b"),
                     (F.col("diff") + F.bit_count(low)).alias("diff"), F.col("sa").alias("na"), F.col("sb").alias("nb"))
             .filter(F.col("diff") <= budget).checkpoint(eager=True))
        size = F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
        fits = (size <= limit) | (F.col("depth") == BITS)
        ready = x.filter(fits & ((F.col("na") > 1) | (F.col("a") != F.col("b")))).select("trie", "depth", "a", "b", "diff")
        done = ready if done is None else done.unionByName(ready)
        hot = x.filter(~fits)
    return done


def trie_links(fps: DataFrame, budget: int = BUDGET, limit: int = 1 << 17) -> DataFrame:
    """Links ``a, b`` (both of the bigint column ``fp``, distinct) that connect all pairs of at most ``budget`` differing
    bits: every such pair lies in one component of the links, and every link is such a pair."""
    ensure_checkpoint_dir(fps.sparkSession)
    tries = F.explode(F.array(*[F.struct(F.lit(i).alias("trie"), F.lit(a).alias("turn"), F.lit(w).alias("width"))
                                for i, (a, w) in enumerate(_runs(budget))]))
    x = fps.select("fp", tries.alias("t")).select("fp", "t.*")
    x = x.withColumn("value", _rotated(F.col("fp"), F.col("turn")))
    x = x.select("trie", "width", "value", _prefix(F.col("value"), F.col("width")).alias("node"))
    pairs = node_pairs(x, budget, limit)
    cold = x.select("trie", F.col("width").alias("depth"), F.col("node").alias("a"), F.col("node").alias("b"),
                    F.lit(0).alias("diff"), F.lit(0).alias("side"), "value")
    if pairs is not None:
        pairs = pairs.checkpoint(eager=True)
        big = x.groupBy("trie", "node").count().filter(F.col("count") > limit).select("trie", "node")
        cold = cold.join(big.withColumnRenamed("node", "a"), ["trie", "a"], "left_anti").select(*cold.columns)
        depths = [r["depth"] for r in pairs.select("depth").distinct().collect()]  # at most one per bit
        x = x.join(big, ["trie", "node"], "left_semi").select("trie", "value", F.explode(F.array(*map(F.lit, depths))).alias("depth"))
        x = x.withColumn("n", _prefix(F.col("value"), F.col("depth")))
        for side, name in enumerate("ab"):
            own = (pairs if name == "a" else pairs.filter("a <> b")).withColumn("n", F.col(name))
            cold = cold.unionByName(own.join(x, ["trie", "depth", "n"]).withColumn("side", F.lit(side)).select(*cold.columns))
    keys = ["trie", "depth", "a", "b"]
    # a node with one entry has no pair; sorting as signed numbers keeps the order below a shared first bit
    dealt = cold.repartition(*keys).sortWithinPartitions(*keys, "side", "value")
    turn = np.array([a for a, _ in _runs(budget)], np.uint64)

    def solve(parts):
        trie, depth, a, b, diff, side, value = (np.concatenate(c) for c in zip(*parts))
        value = value.view(np.uint64)
        same = np.ones(len(value), bool)
        for c in (trie, depth, a, b):
            same[1:] &= c[1:] == c[:-1]
        same[0] = False
        start = np.flatnonzero(~same)
        stop = np.append(start[1:], len(value))
        middle = start + np.add.reduceat((side == 0).astype(np.int64), start)
        own = a[start] == b[start]
        b0, b1 = np.where(own, start, middle), np.where(own, middle, stop)
        live = (middle > start) & (b1 > b0)
        found = []
        for d in np.unique(depth[start]):
            at = np.flatnonzero(live & (depth[start] == d))
            nodes = (start[at], middle[at], b0[at], b1[at], diff[start][at].astype(np.int64))
            found.append(trie_pairs(value, nodes, int(d), budget))
        i, j = joining(len(value), (p for f in found for p in f))
        back = turn[trie[i]]
        turned = lambda v: ((v >> back) | (v << ((np.uint64(BITS) - back) % np.uint64(BITS)))).view(np.int64)
        return pa.record_batch([pa.array(turned(value[i])), pa.array(turned(value[j]))], names=["a", "b"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            held.append(cols)
            rows += batch.num_rows
            if rows >= limit:  # all groups but the last are complete
                whole = [np.concatenate(c) for c in zip(*held)]
                last = np.ones(rows, bool)
                for c in whole[:4]:
                    last &= c == c[-1]
                cut = int(np.flatnonzero(last)[0])
                if cut:
                    yield solve([[c[:cut] for c in whole]])
                held, rows = [[c[cut:] for c in whole]], rows - cut
        if rows:
            yield solve(held)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    budget: int = BUDGET, limit: int = 1 << 17) -> DataFrame:
    """One row per document row: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest doc_id that
    links of at most ``budget`` differing bits reach.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased.  Null and empty texts and texts of blanks
    have fingerprint zero and are linked like any other; a text of fewer words than ``shingle`` is one shingle.  Equal
    texts have equal fingerprints and so one component.  Null doc_ids are kept, but no component is named by one unless
    it holds nothing else (then its id is null).  Repeated rows stay.  An empty table gives no rows.  Other columns are
    not read, whatever their names."""
    ensure_checkpoint_dir(docs.sparkSession)
    x = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("t"))
    raw = fingerprints(x, shingle).checkpoint(eager=True)
    fps = raw.groupBy("fp").agg(F.min("doc_id").alias("low")).checkpoint(eager=True)
    comp = components(trie_links(fps.select("fp"), budget, limit).checkpoint(eager=True))
    linked = fps.join(comp.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("comp").agg(F.min("low").alias("least"))
    linked = linked.join(least, "comp").select("fp", "least")
    home = fps.join(linked, "fp", "left").select("fp", F.coalesce("least", "low").alias("component_id"))
    return raw.join(home, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
