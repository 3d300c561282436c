"""Ranked lexical search by presence masks.

Every document of a block is filed, for each item, under its mask: the bit set of the item's terms that it holds, put
together with one bitmap operation per term.  A mask bounds the score of all its documents by the sum of its terms'
greatest contributions in the block.  Distinct masks are evaluated by descending bound, and an item is finished with
the block as soon as the next bound lies below the k-th best score that the task holds for it.

Two passes over the documents: the first finds the item terms in the whole texts and writes each document's length and
(term, count) lists to the shared folder; their sums are the corpus statistics.  The second scores.  A task gives back
``k`` rows per item, which a window merges.  Items go in blocks of about ``entries`` (item, term) pairs, so what is
broadcast is bounded by that and the largest single item; each block meets all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._text import WORD_BYTES, Hasher, pieces, rebuilt, utf8, words
from .tokens import scratch

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NULL_ID = -(1 << 63)
POSTINGS = 1 << 20  # (document, term) pairs that a task scores at once


class Vocabulary:
    """Terms of a block of items by 64-bit hash; a hash only proposes, the bytes decide."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        self.off = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        _, _, h, first = words(self.data, self.off, Hasher())
        if len(h) != len(terms) or len(np.unique(h)) != len(h):
            raise ValueError("terms must be distinct single words")
        self.order = np.argsort(h)
        self.hash = h[self.order]

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the word, term) of every word that is a term."""
        if not len(self.hash) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        word = np.flatnonzero(self.hash[at] == h)
        term = self.order[at[word]]
        size = end[word] - start[word]
        same = size == self.off[term + 1] - self.off[term]
        word, term, size = word[same], term[same], size[same]
        wrong = np.zeros(len(word), bool)
        live, p = np.arange(len(word)), 0
        while len(live):
            c = data[start[word[live]] + p]
            c = np.where((c >= 65) & (c <= 90), c + 32, c)
            wrong[live] |= c != self.data[self.off[term[live]] + p]
            p += 1
            live = live[size[live] > p]
        return word[~wrong], term[~wrong]


def item_blocks(items: DataFrame, item_col: str, text_col: str, entries: int) -> Iterator[list[tuple[object, list[str]]]]:
    """Lists of (item, its distinct terms), each list of about ``entries`` terms; one list is held at a time."""
    text = F.translate(F.col(f"`{text_col}`"), UPPER, LOWER)
    rows = (items.filter(F.col(f"`{item_col}`").isNotNull())
            .select(F.col(f"`{item_col}`").alias("item"), F.explode(F.regexp_extract_all(text, F.lit(TERM), 0)).alias("term"))
            .distinct().orderBy("item", "term"))
    block, size = [], 0
    for item, term in rows.toLocalIterator():
        if not block or block[-1][0] != item:
            if size >= entries:
                yield block
                block, size = [], 0
            block.append((item, []))
        block[-1][1].append(term)
        size += 1
    if block:
        yield block


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                    pa.array(values.astype(np.int32)))


def postings(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document with a term: its number of terms with repeats, and how often it
    holds each term of the broadcast vocabulary.  ``docs`` has doc_id and t.  A long text is taken in pieces."""
    def run(batches):
        hasher, vocab = Hasher(), rebuilt(Vocabulary, vocabulary.value)
        width = max(len(vocab.hash), 1)
        for batch in batches:
            data, off = utf8(batch.column(1))
            total, held = 0, []  # of a text whose pieces go on
            for i, j, part, o, more in pieces(data, off, ~WORD_BYTES):
                s, e, h, first = words(part, o, hasher)
                word, term = vocab.find(part, s, e, h)
                key, count = np.unique((np.searchsorted(first, word, side="right") - 1) * width + term, return_counts=True)
                n = np.diff(first)
                if more or held:
                    held.append((key, count))
                    total += int(n[0])
                    if more:
                        continue
                    key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
                    count = np.bincount(at, np.concatenate([c for _, c in held]), len(key)).astype(np.int64)
                    n, total, held = np.array([total]), 0, []
                sizes = np.bincount(key // width, minlength=j - i)
                out = pa.record_batch([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)),
                                       _lists(key % width, sizes), _lists(count, sizes)],
                                      names=["doc_id", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<int>")


class Block:
    """Documents of a task in both layouts: terms of a document, documents of a term."""

    def __init__(self, ids, m, size, term, count, weight):
        self.ids, self.term = ids, term
        doc = np.repeat(np.arange(len(ids)), size)
        self.gain = weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m[doc]))
        self.row = np.concatenate([[0], np.cumsum(size)])
        order = np.argsort(term, kind="stable")
        self.docs = doc[order]
        self.at = np.searchsorted(term[order], np.arange(len(weight) + 1))
        self.most = np.zeros(len(weight), np.int64)
        np.maximum.at(self.most, term, self.gain)

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that hold one of the terms, ordered by their mask; start of each distinct mask's documents; and
        the greatest score that each mask allows."""
        live = terms[self.at[terms + 1] > self.at[terms]]
        words_ = max(1, -(-len(live) // 64))
        bits = np.zeros((len(self.ids), words_), np.uint64)
        for b, t in enumerate(live):
            bits[self.docs[self.at[t]:self.at[t + 1]], b >> 6] |= np.uint64(1 << (b & 63))
        doc = np.flatnonzero(bits.any(1))
        if not len(doc):
            return doc, np.zeros(1, np.int64), np.zeros(0, np.int64)
        doc = doc[np.lexsort(bits[doc].T)]
        held = bits[doc]
        new = np.concatenate([[True], (held[1:] != held[:-1]).any(1)])
        start = np.flatnonzero(new)
        flags = np.unpackbits(np.ascontiguousarray(held[start]).view(np.uint8), axis=1, bitorder="little")[:, :len(live)]
        return doc, np.append(start, len(doc)), flags.astype(np.int64) @ self.most[live]

    def scores(self, doc: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of the documents: the gains of their wanted terms."""
        size = self.row[doc + 1] - self.row[doc]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        at = np.arange(size.sum()) - np.repeat(first, size) + np.repeat(self.row[doc], size)
        return np.add.reduceat(np.where(wanted[self.term[at]], self.gain[at], 0), first)  # each has a term


def best_of_block(block: Block, terms: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int, step: int = 64):
    """The ``k`` best (ids, scores) of those held so far and of the block's documents."""
    doc, start, bound = block.masks(terms)
    order = np.argsort(-bound, kind="stable")
    wanted = np.zeros(len(block.most), bool)
    wanted[terms] = True
    at = 0
    while at < len(order):
        if len(score) >= k and bound[order[at]] < score[-1]:
            break  # no later mask can reach the k-th score
        some = order[at:at + step]
        if len(score) >= k:
            some = some[bound[some] >= score[-1]]
        take = doc[np.concatenate([np.arange(start[g], start[g + 1]) for g in some])]
        ids, score = np.append(ids, block.ids[take]), np.append(score, block.scores(take, wanted))
        keep = np.lexsort((ids, -score))[:k]
        ids, score = ids[keep], score[keep]
        keep = score > 0
        ids, score = ids[keep], score[keep]
        at += step
    return ids, score


def _best(lists: DataFrame, model, item_type: str, k: int) -> DataFrame:
    """``item, doc_id, score``: for each task its ``k`` best documents of every item."""
    def run(batches):
        item_ids, item_terms, weight, kind = model.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in item_ids]

        def take(held):
            ids, m, size, term, count = (np.concatenate(x) for x in zip(*held))
            block = Block(ids, m, size, term, count.astype(np.int64), weight)
            for i, terms in enumerate(item_terms):
                best[i] = best_of_block(block, terms, *best[i], k)

        held, load = [], 0
        for batch in batches:
            terms, counts = batch.column(2), batch.column(3)
            size = np.diff(np.asarray(terms.offsets)).astype(np.int64)
            term, count = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            ends = np.cumsum(size)
            a = 0
            while a < len(size):  # as many rows as fit, one at least
                before = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, before + POSTINGS - load, side="right")))
                lo, hi = before, ends[b - 1]
                held.append((batch.column(0).slice(a, b - a).to_numpy(), batch.column(1).slice(a, b - a).to_numpy(),
                             size[a:b], term[lo:hi], count[lo:hi]))
                load += int(hi - lo)
                if load >= POSTINGS or sum(len(x[0]) for x in held) >= POSTINGS:
                    take(held)
                    held, load = [], 0
                a = b
        if held:
            take(held)
        n = np.array([len(ids) for ids, _ in best])
        if n.sum():
            yield pa.record_batch([pa.array(item_ids, kind).take(pa.array(np.repeat(np.arange(len(n)), n))),
                                   pa.array(np.concatenate([x for x, _ in best])),
                                   pa.array(np.concatenate([x for _, x in best]))], names=["item", "doc_id", "score"])

    return lists.mapInArrow(run, f"item {item_type}, doc_id bigint, score bigint")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", entries: int = 1 << 18) -> DataFrame:
    """The ``k`` best documents of every item, with score above 0: ``item_id, rank (from 1), doc_id, score``.

    The score of a document sums, over the item's distinct terms, ``w * ((10^9 tf) div (1000 tf + 8 m))`` with
    ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and ``m = 10 + (90 n N) div L``: N documents with terms, L their terms,
    n the document's terms, df the documents with the term, tf its occurrences.  Equal scores go by ascending doc_id.

    Null and empty texts have no terms and count nowhere.  Null doc_ids are documents, ranked before all others of their
    score.  Each repeated document row is a document of its own; repeated item rows are one item with the terms of all.
    Items with a null id or without terms get no rows, and so does every item when either table is empty.  Other columns
    of both tables are not read, whatever their names."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NULL_ID)).alias("doc_id"),
                       F.col(f"`{text_col}`").alias("t"))
    item_type = items.schema[item_col].dataType.simpleString()
    out = None
    for block in item_blocks(items, item_col, item_text, entries):
        terms = sorted({t for _, own in block for t in own})
        number = {t: i for i, t in enumerate(terms)}
        place = scratch(spark, "postings")
        postings(docs, spark.sparkContext.broadcast(vars(Vocabulary(terms)))).write.parquet(place)
        lists = spark.read.parquet(place)
        total = lists.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
        if not total["n"]:
            continue
        seen = dict(lists.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row per term of the block
        weight = np.array([math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * seen.get(i, 0) + 1)))
                           for i in range(len(terms))], np.int64)
        kind = pa.array([item for item, _ in block]).type
        model = spark.sparkContext.broadcast(([item for item, _ in block],
                                              [np.array([number[t] for t in own]) for _, own in block], weight, kind))
        m = F.expr(f"10 + cast((cast(90 as decimal(38,0)) * n * {total['n']}) div {total['l']} as bigint)")
        found = _best(lists.filter(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "counts"), model, item_type, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"item {item_type}, doc_id bigint, score bigint")
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    return (out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("item").alias(item_col), "rank", F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), "score"))
