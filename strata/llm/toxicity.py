"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is its word embedding (hashed vocabulary) and the mean of its character embeddings (hashed grams of four
neighbouring bytes, so unseen forms of a known stem are close to it).  A document is
cut into overlapping windows of words; in each window a forward and a backward GRU read the words, attention pools
their states, and a logistic unit scores the window.  A document's score is that of its worst window, so a toxic
passage shows at any place of any length of text.

Training sees at most ``per_class`` labelled documents of each class, whole texts of any length that together hold at most
``per_class * max_bytes`` bytes (a bounded sample, the only texts that come to the driver).  A document's windows share its label through the worst window (multiple
instance learning): windows of clean documents are all clean, of a toxic one only the worst is pushed up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ._text import Hasher, lower_bytes, mix64, rebuilt, spans, utf8, words
from .quality import class_weights, held_out, label_sample

WINDOW, STRIDE = 64, 48


def windows(first: np.ndarray, size: int = WINDOW, stride: int = STRIDE):
    """(start word, length, document) of the overlapping windows of documents with word ranges ``first``; the last
    window of a document ends with it.  A document without words has no window."""
    n = np.diff(first)
    count = np.where(n > size, -(-(n - size) // stride) + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.minimum(k * stride, np.maximum(n[doc] - size, 0))
    return first[doc] + at, np.minimum(n[doc], size), doc


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def _scatter(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` by row number."""
    return np.stack([np.bincount(rows, v, n) for v in values.T], 1).astype(values.dtype)


class Network:
    """Weights and passes.  ``dirs`` holds the forward and the backward GRU: input weights, state weights, biases."""

    def __init__(self, word_rows: int = 1 << 15, char_rows: int = 1 << 14, dim: int = 8, hidden: int = 8,
                 seed: int = 11):
        r = np.random.default_rng(seed)
        g = lambda *s, k=0.3: (r.standard_normal(s) * k).astype(np.float32)
        self.word_rows, self.char_rows, self.h = word_rows, char_rows, hidden
        self.p = {"word": g(word_rows, dim, k=0.1), "char": g(char_rows, dim, k=0.1), "att": g(2 * hidden),
                  "out": g(2 * hidden), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": g(2 * dim, 3 * hidden), f"u{d}": g(hidden, 3 * hidden),
                       f"c{d}": np.zeros(3 * hidden, np.float32)}

    # -- inputs --------------------------------------------------------------------------------------------------

    def vocabulary(self, data, start, end, h):
        """Distinct words of a batch: (inverse, word rows, rows of the four-byte grams around each byte, first gram of
        each word)."""
        _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        s, size = start[at], (end - start)[at]
        first = np.cumsum(size) - size
        pos = np.arange(int(size.sum())) - np.repeat(first - s, size)
        a = data[pos].astype(np.uint64)
        place = np.arange(len(a)) - np.repeat(first, size)
        left = np.repeat(size, size) - place
        gram = np.zeros(len(a), np.uint64)
        for step in (-2, -1, 0, 1):  # four neighbouring bytes, zero outside the word
            near = np.roll(a, -step)
            gram = gram * np.uint64(256) + np.where((place + step >= 0) & (left > step), near, np.uint64(0))
        grams = (mix64(gram) % np.uint64(self.char_rows)).astype(np.int64)
        return inverse, (h[at] % np.uint64(self.word_rows)).astype(np.int64), grams, first

    def embed(self, word_rows, grams, first):
        """Input vectors of distinct words."""
        if not len(word_rows):
            return np.zeros((0, self.p["wf"].shape[0]), np.float32)
        size = np.diff(np.append(first, len(grams))).astype(np.float32)
        chars = np.add.reduceat(self.p["char"][grams], first, axis=0) / size[:, None]
        return np.concatenate([self.p["word"][word_rows], chars], 1)

    # -- scoring -------------------------------------------------------------------------------------------------

    def window_logits(self, x: np.ndarray, ids: np.ndarray, start: np.ndarray, size: np.ndarray, batch: int = 2048):
        """Logit of every window; ``x`` holds the distinct words' inputs, ``ids`` the words of the batch."""
        out = np.empty(len(start), np.float32)
        proj = {d: x @ self.p[f"w{d}"] + self.p[f"c{d}"] for d in "fb"}
        head = {"f": np.stack([self.p["att"][:self.h], self.p["out"][:self.h]], 1),
                "b": np.stack([self.p["att"][self.h:], self.p["out"][self.h:]], 1)}
        order = np.argsort(-size, kind="stable")
        for a in range(0, len(order), batch):
            w = order[a:a + batch]
            s, n = start[w], size[w]
            steps, m = int(n[0]), len(w)
            score = np.full((steps, m), -np.inf, np.float32)
            value = np.zeros((steps, m), np.float32)
            for d in "fb":
                u, h = self.p[f"u{d}"], np.zeros((m, self.h), np.float32)
                k = self.h
                for t in range(steps):
                    live = m if t < n[-1] else int(np.searchsorted(-n, -t, side="left"))
                    at = t if d == "f" else n[:live] - 1 - t
                    xp = proj[d][ids[s[:live] + at]]
                    hu = h[:live] @ u
                    zr = _sigmoid(xp[:, :2 * k] + hu[:, :2 * k])
                    c = np.tanh(xp[:, 2 * k:] + zr[:, k:] * hu[:, 2 * k:])
                    h[:live] = c + zr[:, :k] * (h[:live] - c)
                    two = h[:live] @ head[d]
                    if d == "f":
                        score[t, :live], value[t, :live] = two[:, 0], two[:, 1]
                    else:
                        cols = np.arange(live)
                        score[at, cols] += two[:, 0]
                        value[at, cols] += two[:, 1]
            e = np.exp(score - score.max(0))
            out[w] = (e * value).sum(0) / e.sum(0) + self.p["bias"][0]
        return out

    def document_logits(self, data, off, hasher) -> np.ndarray:
        """Worst window of every document; an empty document has the bias alone."""
        s, e, h, first = words(data, off, hasher)
        ids, rows, grams, at = self.vocabulary(lower_bytes(data), s, e, h)
        start, size, doc = windows(first)
        out = np.full(len(off) - 1, -np.inf, np.float32)
        if len(start):
            np.maximum.at(out, doc, self.window_logits(self.embed(rows, grams, at), ids, start, size))
        return np.where(np.isinf(out), min(self.p["bias"][0], self.empty), out)

    empty = -1.0  # a text without words is never toxic

    # -- training ------------------------------------------------------------------------------------------------

    def gradient(self, word_rows, grams, first, ids, start, size, grad_of):
        """Gradients for a batch of windows; ``grad_of(logits)`` gives dLoss / dLogit."""
        steps, m, k = int(size.max()), len(start), self.h
        t = np.arange(steps)[:, None]
        mask = t < size
        # only the words of these windows
        used, local = np.unique(ids[start + np.minimum(t, size - 1)], return_inverse=True)
        local = local.reshape(steps, m)
        length = np.diff(np.append(first, len(grams)))[used]
        grams = grams[np.arange(int(length.sum())) + np.repeat(first[used] - (np.cumsum(length) - length), length)]
        word_rows, first = word_rows[used], np.cumsum(length) - length
        x = self.embed(word_rows, grams, first)
        at = {"f": local, "b": np.take_along_axis(local, np.maximum(size - 1 - t, 0), 0)}
        states, cache = {}, {}
        for d in "fb":
            xin = x[at[d]]
            proj = xin @ self.p[f"w{d}"] + self.p[f"c{d}"]
            h = np.zeros((m, k), np.float32)
            states[d], cache[d] = np.zeros((steps, m, k), np.float32), []
            for i in range(steps):
                hu = h @ self.p[f"u{d}"]
                zr = _sigmoid(proj[i, :, :2 * k] + hu[:, :2 * k])
                z, r = zr[:, :k], zr[:, k:]
                c = np.tanh(proj[i, :, 2 * k:] + r * hu[:, 2 * k:])
                new = np.where(mask[i][:, None], c + z * (h - c), h)
                cache[d].append((h, z, r, c, hu[:, 2 * k:]))
                h = states[d][i] = new
            cache[d] = (xin, cache[d])
        back = np.where(mask, size - 1 - t, 0)
        cols = np.arange(m)
        both = np.concatenate([states["f"], states["b"][back, cols]], 2)
        s = np.where(mask, both @ self.p["att"], -np.inf)
        a = np.exp(s - s.max(0))
        a /= a.sum(0)
        pooled = (a[:, :, None] * both).sum(0)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        dl = grad_of(logit).astype(np.float32)
        g = {n: np.zeros_like(v) for n, v in self.p.items()}
        g["bias"][0], g["out"] = dl.sum(), pooled.T @ dl
        dpool = dl[:, None] * self.p["out"]
        da = (both * dpool).sum(2)
        ds = a * (da - (a * da).sum(0))
        g["att"] = np.einsum("tm,tmk->k", ds, both)
        dboth = a[:, :, None] * dpool + ds[:, :, None] * self.p["att"]
        dback = dboth[back, cols, k:] * mask[:, :, None]  # reversing a window twice gives it back
        dx = np.zeros_like(x)
        for d, dh_all in (("f", dboth[:, :, :k]), ("b", dback)):
            u, (xin, steps_of) = self.p[f"u{d}"], cache[d]
            dh = np.zeros((m, k), np.float32)
            dproj = np.zeros((steps, m, 3 * k), np.float32)
            for i in range(steps - 1, -1, -1):
                h, z, r, c, hc = steps_of[i]
                dh = dh + dh_all[i] * mask[i][:, None]
                live = mask[i][:, None]
                dz = dh * (h - c) * z * (1 - z) * live
                dc = dh * (1 - z) * (1 - c * c) * live
                dr = dc * hc * r * (1 - r)
                dproj[i] = np.concatenate([dz, dr, dc], 1)
                dhu = np.concatenate([dz, dr, dc * r], 1)
                g[f"u{d}"] += h.T @ dhu
                dh = np.where(live, dh * z, dh) + dhu @ u.T
            flat = dproj.reshape(-1, 3 * k)
            g[f"c{d}"] = flat.sum(0)
            g[f"w{d}"] = xin.reshape(-1, xin.shape[2]).T @ flat
            dx += _scatter(at[d][mask], (dproj @ self.p[f"w{d}"].T)[mask], len(dx))
        dim = self.p["word"].shape[1]
        g["word"] = _scatter(word_rows, dx[:, :dim], self.word_rows)
        g["char"] = _scatter(grams, np.repeat(dx[:, dim:] / length[:, None], length, axis=0), self.char_rows)
        return g, logit

    def fit(self, data, off, y, weight, epochs: int = 8, batch: int = 128, rate: float = 0.02, seed: int = 5):
        """Adam on the worst window of every document; the first epochs also push down every window of clean ones."""
        s, e, h, first = words(data, off, Hasher())
        ids, rows, grams, at = self.vocabulary(lower_bytes(data), s, e, h)
        start, size, doc = windows(first)
        if not len(start) or y.min() == y.max():
            self.p["bias"][0] = 2.0 if len(y) and y.min() == 1 else -2.0
            return self
        r = np.random.default_rng(seed)
        m1 = {n: np.zeros_like(v) for n, v in self.p.items()}
        m2 = {n: np.zeros_like(v) for n, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            logits = self.window_logits(self.embed(rows, grams, at), ids, start, size)
            if epoch:
                order = np.lexsort((-logits, doc))
            else:  # nothing is learnt yet: a random window
                order = np.lexsort((r.random(len(doc)), doc))
            worst = order[np.append(True, doc[order][1:] != doc[order][:-1])]
            extra = r.permutation(np.flatnonzero(y[doc] == 0))[:len(worst)]
            chosen = r.permutation(np.concatenate([worst, extra, worst[y[doc[worst]] == 1]]))
            for b in range(0, len(chosen), batch):
                w = chosen[b:b + batch]
                if len(w) < 2:
                    continue
                goal, wt = y[doc[w]], weight[doc[w]]
                g, _ = self.gradient(rows, grams, at, ids, start[w], size[w],
                                     lambda z: wt * (_sigmoid(z) - goal) / len(w))
                step += 1
                lr = rate * (1 - 0.8 * epoch / epochs)
                for n in self.p:
                    m1[n] += 0.1 * (g[n] - m1[n])
                    m2[n] += 0.01 * (g[n] ** 2 - m2[n])
                    if n == "word":  # words seen once should not stay loud
                        self.p[n] *= 1 - 0.3 * lr
                    self.p[n] -= lr * (m1[n] / (1 - 0.9 ** step)) / (np.sqrt(m2[n] / (1 - 0.99 ** step)) + 1e-6)
        return self


def _buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pa.array(texts, pa.large_string()))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0,
                 per_class: int = 1200, max_bytes: int = 6000, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """Train on a bounded sample of each class: the documents of smallest id hash, at most ``per_class`` of them and at most
    ``per_class * max_bytes`` bytes in all.  Texts are taken whole; one that does not fit in what is left is passed over.

    Null texts are empty; an id with several texts takes the one of smallest hash.  Without labelled documents of both
    classes the network keeps one constant answer; a class whose labelled texts all exceed the bound is an error."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    bound = per_class * max_bytes
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    lengths = texts.groupBy("doc_id").agg(F.min(F.octet_length("t")).alias("n"))
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{label}`").alias("y"))
             .join(lengths, "doc_id")).checkpoint(eager=True)
    sample, sizes = label_sample(known.filter(F.col("n") <= bound), "y", folds, fold, per_class)
    if len(sizes) < 2:
        lost = label_sample(known, "y", folds, fold, per_class)[1].keys() - sizes.keys()
        if lost:
            raise ValueError(f"all texts labelled {sorted(lost)} exceed {bound} bytes, the bound of a class's sample")
    th = F.xxhash64("t")
    rows = (texts.filter(F.octet_length("t") <= bound).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "y").agg(F.min(F.struct(th.alias("th"), F.octet_length("t").alias("n"))).alias("m"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", "y", "m.th", "m.n").collect())
    left, chosen = {0: bound, 1: bound}, []
    for row in rows:
        if row["n"] <= left[row["y"]]:
            left[row["y"]] -= row["n"]
            chosen.append((row["doc_id"], row["y"], row["th"]))
    picked = spark.createDataFrame(chosen, "doc_id bigint, y int, th bigint")
    found = (texts.join(F.broadcast(picked), "doc_id").filter(th == F.col("th")).groupBy("doc_id", "y")
             .agg(F.min("t").alias("t")).orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    kept = {c: [r["t"] for r in found if r["y"] == c] for c in (0, 1)}
    texts = kept[0] + kept[1]
    y = np.array([0.0] * len(kept[0]) + [1.0] * len(kept[1]))
    net = Network()
    data, off = _buffer(texts)
    return net.fit(data, off, y, np.sqrt(class_weights(y, sizes)) if len(y) else y)


def score_toxicity(docs: DataFrame, net: Network, folds: int = 5, fold: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the ``keep`` columns for every document, over its whole text.

    Null texts are empty and score as not toxic.  Repeated rows stay; an empty table gives no rows.  Extra columns of
    ``docs`` may have any name; one in ``keep`` that is also a name of the result raises ValueError."""
    keep = keep or []
    names = [c for c in keep if c.lower() in ("doc_id", "held_out", "score", "predicted")]
    if names:
        raise ValueError(f"columns to keep clash with the result: {names}")
    held = docs.sparkSession.sparkContext.broadcast(vars(net))

    def run(batches):
        model, hasher = rebuilt(Network, held.value), Hasher()
        for batch in batches:
            data, off = utf8(batch.column(1))
            parts = [model.document_logits(data[off[i]:off[j]], off[i:j + 1] - off[i], hasher) for i, j in spans(off)]
            z = np.concatenate(parts) if parts else np.zeros(0, np.float32)
            cols = [batch.column(0), pa.array(_sigmoid(z.astype(np.float64))), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", *(f"k{i}" for i in range(len(keep)))])

    x = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("t"),
                    *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    schema = x.select("doc_id", F.lit(0.0).alias("score"), *[f"k{i}" for i in range(len(keep))]).schema
    out = x.mapInArrow(run, schema)
    return out.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)])
