"""Near-duplicate classes by DartMinHash signatures and banded joining.

A document is the multiset of its five-word shingles; its similarity to another is the weighted Jaccard of the two.
Every element owns a region of weight x rank.  Hashed darts (a unit Poisson process per unit of weight, seeded by the
element alone) fall into the regions; a document keeps those below its weight and below a rank limit that lets about
``k ln k + 2k`` darts through, so the cost is that of its elements plus the darts, not elements times k.  Each dart
belongs to one of ``k`` coordinates and the earliest dart of each coordinate is the signature: two signatures agree at
a coordinate with probability equal to the similarity.

``rows`` coordinates make a band; texts that share a band meet.  Every text is checked exactly against the smallest one
that it meets.  In buckets that the resulting links leave in several components, all pairs of different components whose
sizes allow the similarity are then checked exactly inside tasks, block against block, each pair of blocks once for all
bands, and only links that join components leave them, so no pair that shares a band is lost to the choice of the
representative and no element set travels once per band.  Equal word sequences are one node from the start, so copies never make pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import running_sum_within
from ..session import ensure_checkpoint_dir
from ._text import Hasher, mix64, powers, shingles, spans, uniform, utf8, words
from .links import components, filtered, key_bitmap, tasks_for
from .tokens import scratch

K, ROWS, SHINGLE, SIMILAR = 96, 4, 5, 0.8
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _step(n: int) -> np.uint64:
    """n golden steps modulo 2^64."""
    return np.uint64(n * int(_GOLD) & 0xFFFFFFFFFFFFFFFF)


_SEQ = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)


def sequence_keys(data, off, h, first) -> np.ndarray:
    """128-bit keys of the documents' word sequences; a text without words is keyed by its bytes."""
    out = np.zeros((len(off) - 1, 2), np.uint64)
    none = np.diff(first) == 0
    for i, base in enumerate(_SEQ):
        at = [(h, first)] if not none.any() else [(h, first), (mix64(data.astype(np.uint64) + np.uint64(i)), off)]
        for kind, (x, bounds) in enumerate(at):
            c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(x + np.uint64(i)) * powers(len(x), base),
                                                                  dtype=np.uint64)])
            inv = powers(int(bounds[-1]) + 1, pow(base, -1, 1 << 64))
            a, b = bounds[:-1], bounds[1:]
            key = mix64((c[b] - c[a]) * inv[a] + (b - a).astype(np.uint64) + np.uint64(kind * 1000003))
            out[:, i] = np.where(none, key, out[:, i]) if kind else key
    return out


def cells(sh: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, seed) of every unit of weight: the c-th occurrence of a shingle in a document is its c-th cell."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((sh, doc))
    s, d = sh[order], doc[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    nth = np.arange(len(s)) - np.repeat(at, np.diff(np.append(at, len(s))))
    return d, mix64(s + nth.astype(np.uint64) * _GOLD)


def signatures(doc: np.ndarray, seed: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """DartMinHash signatures (n x k, 32 bits each) from cells; a document without cells has zeros."""
    sig = np.zeros((n, k), np.uint32)
    weight = np.bincount(doc, minlength=n)
    limit = np.where(weight > 0, (k * math.log(k) + 2 * k) / np.maximum(weight, 1), 0.0)
    while len(doc):
        best = np.full(n * k, np.inf)
        held = []
        d, s, rank = doc, seed, np.zeros(len(doc))
        nth = 0
        while len(d):
            nth += 1
            dart = mix64(s + _step(nth))
            rank = rank - np.log(uniform(dart))  # next arrival of the cell's unit process
            live = rank <= limit[d]
            d, s, rank = d[live], s[live], rank[live]
            place = mix64(dart[live])
            key = d * k + (place % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, key, rank)
            held.append((key, rank, (place >> np.uint64(32)).astype(np.uint32)))
        key, rank, ident = (np.concatenate(x) for x in zip(*held))
        won = rank == best[key]
        grid = np.zeros(n * k, np.uint32)
        np.maximum.at(grid, key[won], ident[won])
        full = np.isfinite(best.reshape(n, k)).all(1)
        done = full & (limit > 0)
        sig[done] = grid.reshape(n, k)[done]
        again = ~full & (weight > 0) & (limit > 0)  # a coordinate without a dart: twice the rank limit
        limit = np.where(again, limit * 2, 0.0)
        keep = again[doc]
        doc, seed = doc[keep], seed[keep]
    return sig


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bands = sig.shape[1] // rows
    x = sig[:, :bands * rows].reshape(len(sig), bands, rows).astype(np.uint64)
    out = np.broadcast_to(mix64(np.arange(bands, dtype=np.uint64)), (len(sig), bands)).copy()
    for r in range(rows):
        out = mix64(out ^ (x[:, :, r] + _step(r + 1)))
    return out


def _blob(rows: np.ndarray) -> pa.Array:
    """Rows of a contiguous matrix as Arrow binary."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * rows.shape[1]
    off = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(off), pa.py_buffer(rows.tobytes())])


def sketch(docs: DataFrame, shingle: int = SHINGLE, k: int = K, rows: int = ROWS) -> DataFrame:
    """``doc_id, th, node, sig, bands`` per document; ``docs`` has doc_id, t (text) and th (text hash)."""
    def run(batches):
        hasher = Hasher()
        for batch in batches:
            data, off = utf8(batch.column(1))
            for i, j in spans(off):
                part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                _, _, h, first = words(part, o, hasher)
                sh, sf = shingles(h, first, shingle)
                sig = signatures(*cells(sh, sf), j - i, k)
                bands = band_keys(sig, rows)
                empty = np.diff(sf) == 0
                size = np.where(empty, 0, bands.shape[1])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()),
                                                 pa.array(bands[~empty].ravel().view(np.int64)))
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                                       _blob(sequence_keys(part, o, h, first)),
                                       _blob(sig), lists], names=["doc_id", "th", "node", "sig", "bands"])

    return docs.mapInArrow(run, "doc_id bigint, th bigint, node binary, sig binary, bands array<bigint>")


def _element_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``node, size, cells`` (sorted 64-bit hashes of the weight units, packed) of the given documents."""
    def run(batches):
        hasher = Hasher()
        for batch in batches:
            data, off = utf8(batch.column(1))
            for i, j in spans(off):
                part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                _, _, h, first = words(part, o, hasher)
                sh, sf = shingles(h, first, shingle)
                doc, seed = cells(sh, sf)
                seed = seed.astype("<u8", copy=False)
                order = np.lexsort((seed, doc))
                ends = np.cumsum(np.bincount(doc, minlength=j - i)).astype(np.int32) * 8
                blob = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(np.append(np.int32(0), ends)),
                                                                  pa.py_buffer(seed[order].tobytes())])
                yield pa.record_batch([_blob(sequence_keys(part, o, h, first)), blob], names=["node", "cells"])

    return docs.mapInArrow(run, "node binary, cells binary")


def weighted_jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / max(len(both) - common, 1)


def _verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity is at least ``similar``."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("cells").alias("ca")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("cells").alias("cb")), "b").select("a", "b", "ca", "cb")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.as_py(), y.as_py()
                lo, hi = sorted((len(x), len(y)))
                keep.append(lo >= similar * hi and weighted_jaccard(x, y) >= similar)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def _blocks(members: DataFrame, size: DataFrame, room: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Nodes dealt into blocks of about ``room`` bytes: (``node, owner, block``; pairs of blocks ``owner, lb, rb``).

    Buckets that share nodes form a group.  Small groups are packed together by hash; the nodes of a larger one are taken
    in the order of their component's least bucket, and two of its blocks meet only if they share a bucket and do not
    both lie in one component.  A node counts as ``least`` bytes at least."""
    star = members.groupBy("key").agg(F.min("node").alias("b"))
    group = components(members.join(star, "key").select(F.col("node").alias("a"), "b")).select("node", F.col("comp").alias("grp"))
    low = members.groupBy("comp").agg(F.min("key").alias("low"))
    x = (members.select("node", "comp").distinct().join(low, "comp").join(group, "node").join(size, "node")
         .withColumn("weight", F.greatest("bytes", F.lit(least)).cast("bigint")))
    total = x.groupBy("grp").agg(F.sum("weight").alias("total"))
    parts = tasks_for(members.count(), members.sparkSession)
    x = x.join(total, "grp").coalesce(parts).checkpoint(eager=True)
    few, many = x.filter(F.col("total") <= room), x.filter(F.col("total") > room)
    packs = -(-int(few.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]) // room) or 1
    pack = F.pmod(F.xxhash64("grp"), F.lit(packs)).cast("bigint")
    none = F.lit(b"")
    dealt = few.select("node", "comp", none.alias("owner"), pack.alias("block"))
    pairs = dealt.select("owner", F.col("block").alias("lb"), F.col("block").alias("rb")).distinct()
    if not many.isEmpty():
        many = running_sum_within(many.withColumn("place", F.struct("low", "comp", "node")), ["grp"], "place", "weight", "before")
        many = many.select("node", "comp", F.col("grp").alias("owner"), F.floor(F.col("before") / room).alias("block")).checkpoint(eager=True)
        dealt = dealt.unionByName(many)
        at = members.join(many.select("node", "owner", "block"), "node").select("key", "owner", "block").distinct()
        met = at.withColumnRenamed("block", "lb").join(at.withColumnRenamed("block", "rb"), ["key", "owner"]).filter("lb <= rb")
        span = many.groupBy("owner", "block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        met = met.select("owner", "lb", "rb").distinct()
        for side in ("lb", "rb"):
            met = met.join(span.select("owner", F.col("block").alias(side), F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}")),
                           ["owner", side])
        one = (F.col("lo_lb") == F.col("hi_lb")) & (F.col("lo_rb") == F.col("hi_rb")) & (F.col("lo_lb") == F.col("lo_rb"))
        pairs = pairs.unionByName(met.filter(~one).select("owner", "lb", "rb"))
    return dealt.coalesce(parts).checkpoint(eager=True), pairs.coalesce(parts).checkpoint(eager=True)


def _joining_links(members: DataFrame, payload: DataFrame, similar: float, k: int, rows: int, room: int = 1 << 22,
                   least: int = 1 << 13) -> DataFrame:
    """Links (a, b) that join different components inside buckets.

    ``members``: key, node, comp of the buckets that lie in several components; ``payload``: node, sig, cells.  Nodes go
    into blocks of bounded bytes (and at most ``room / least`` nodes) and two blocks meet once, for all bands.  A task
    takes up a pair only if its signatures share a band, its sizes allow the similarity and the links found so far leave
    its components apart; it checks the pair exactly and returns the links that join, fewer than it has components."""
    dealt, pairs = _blocks(members, payload.select("node", F.length("cells").alias("bytes")), room, least)
    whole = dealt.join(payload, "node")
    left = whole.join(pairs.withColumn("block", F.col("lb")), ["owner", "block"]).drop("block")
    right = whole.join(pairs.filter("lb <> rb").withColumn("block", F.col("rb")), ["owner", "block"]).drop("block")
    bands = k // rows

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        both = [left] + ([right.rename_columns(left.column_names)] if right.num_rows else [])
        if left.num_rows:
            ids, comps, sets = ([x for t in both for x in t.column(c).to_pylist()] for c in ("l_node", "l_comp", "l_cells"))
            sig = np.frombuffer(b"".join(x for t in both for x in t.column("l_sig").to_pylist()), np.uint32).reshape(-1, k)
            sig = np.ascontiguousarray(sig[:, :bands * rows]).reshape(-1, bands, rows)
            _, at = np.unique(np.array([c.hex() for c in comps]), return_inverse=True)
            home = np.arange(at.max() + 1)  # component number -> joined component, kept flat
            size = np.array([len(x) for x in sets])
            n = left.num_rows
            for i in range(n):
                j = np.arange(i + 1, n) if len(both) == 1 else np.arange(n, len(ids))
                j = j[(home[at[j]] != home[at[i]]) & (np.minimum(size[j], size[i]) >= similar * np.maximum(size[j], size[i]))]
                if not len(j):
                    continue
                j = j[(sig[j] == sig[i]).all(2).any(1)]
                for q in j.tolist():
                    x, y = home[at[i]], home[at[q]]
                    if x != y and weighted_jaccard(sets[i], sets[q]) >= similar:
                        home[home == y] = x
                        a.append(max(ids[i], ids[q]))
                        b.append(min(ids[i], ids[q]))
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    left = left.select(*[F.col(c).alias(f"l_{c}") for c in right.columns])  # both sides come from one table
    return left.groupBy("l_owner", "l_lb", "l_rb").cogroup(right.groupBy("owner", "lb", "rb")).applyInArrow(
        run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR,
                    shingle: int = SHINGLE, k: int = K, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id, th`` (xxhash64 of the text), ``class_id`` (smallest doc_id of its class),
    ``kept`` (this is the class's document that stays) and ``class_key``.

    Two texts are linked when the weighted Jaccard of their ``shingle``-word multisets is at least ``similar``; classes
    are the connected components.  A text of fewer words is one shingle.  Null texts are empty; texts without words are
    copies of each other only if equal.  Null ids come first in a class.  Repeated rows are copies, the one that stays
    is the one of smallest (doc_id, th); of identical rows both are marked and the caller drops one.  An empty table
    gives no rows."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    x = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("t"), F.xxhash64(text).alias("th"))
    place = scratch(spark, "sketches")
    sketch(x, shingle, k, rows).write.parquet(place)
    raw = spark.read.parquet(place)
    # one node per distinct word sequence, wherever its copies lie
    nodes = raw.groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.first("sig").alias("sig"),
                                    F.first("bands").alias("bands")).checkpoint(eager=True)
    bands = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = bands.groupBy("key").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n"))
    buckets = buckets.filter("n > 1").checkpoint(eager=True)
    met = bands.join(buckets.select("key", "b"), "key").select("key", "node", "b").checkpoint(eager=True)
    # every node is checked against one other, the smallest one that shares a bucket with it
    pairs = met.groupBy(F.col("node").alias("a")).agg(F.min("b").alias("b")).checkpoint(eager=True)
    # the texts of nodes in pairs: a bounded bitmap spares most others the shuffle, the join decides
    reps = pairs.select(F.col("a").alias("node")).join(nodes.select("node", "rep"), "node").select(
        F.col("rep.doc_id").alias("rd"), F.col("rep.th").alias("rt")).checkpoint(eager=True)
    likely = filtered(x.select("doc_id", "t", "th", F.xxhash64("th").alias("hh")), "hh",
                      key_bitmap(reps.filter("rt is not null"), "rt"))
    chosen = likely.join(reps, F.col("doc_id").eqNullSafe(F.col("rd")) & (F.col("th") == F.col("rt")), "left_semi")
    place = scratch(spark, "elements")
    _element_sets(chosen.select("doc_id", "t"), shingle).dropDuplicates(["node"]).write.parquet(place)
    sets = spark.read.parquet(place)
    links = _verified(pairs.filter("a <> b"), sets, similar).checkpoint(eager=True)
    comp = components(links)
    # buckets that the links leave in several components
    members = (met.join(comp, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))).checkpoint(eager=True)
    split = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    open_ones = members.join(split.select("key"), "key")
    open_ones = open_ones.coalesce(tasks_for(open_ones.count(), spark)).checkpoint(eager=True)
    payload = nodes.select("node", "sig").join(sets, "node")
    links = links.unionByName(_joining_links(open_ones, payload, similar, k, rows).checkpoint(eager=True))
    comp = components(links)
    home = nodes.select("node", "rep").join(comp, "node", "left").select(
        "node", "rep", F.coalesce("comp", "node").alias("class_key"))
    best = home.groupBy("class_key").agg(F.min("rep").alias("best"))
    home = home.join(best, "class_key").select("node", "class_key", "best")
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & F.col("th").eqNullSafe(F.col("best.th"))
    return raw.select("doc_id", "th", "node").join(home, "node").select(
        "doc_id", "th", F.col("best.doc_id").alias("class_id"), kept.alias("kept"), "class_key")
