"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature (and every chosen pair of features) has a lookup table over bins.  Cyclic boosting visits the features in
turn; each visit fits a shallow tree to the current gradient and adds its damped leaf values to the feature's table, so
the trees melt into tables.  Then the pairs with the largest gain get two-dimensional tables the same way.  A score is
the logistic of the intercept plus one table entry per term: vectorised bin look-ups and additions.

The features of all documents are computed on the executors from whole texts.  Only the feature rows of a bounded
sample of labelled documents come to the driver for the fit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._text import Hasher, spans, utf8, words

FEATURES = ["log_bytes", "log_words", "word_length", "long_words", "unique_words", "repeated_next", "top_gap",
            "letters", "upper", "digits", "spaces", "line_feeds", "sentence_marks", "pipes", "marks", "brackets",
            "quotes", "non_ascii", "control", "words_per_line", "words_per_mark", "byte_entropy"]
_CLASSES = {"letters": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789",
            "spaces": b" \t", "line_feeds": b"\n\r", "sentence_marks": b".,;:!?", "pipes": b"|",
            "marks": b"#$%&*@^~+=_\\/", "brackets": b"()[]{}<>", "quotes": b"'\"`-", "non_ascii": bytes(range(128, 256)),
            "control": bytes([*range(0, 9), 11, 12, *range(14, 32), 127])}


def features(data: np.ndarray, off: np.ndarray, hasher: Hasher) -> np.ndarray:
    """Feature matrix (documents x FEATURES) of a batch; an empty text has zeros."""
    n = len(off) - 1
    hist = np.stack([np.bincount(data[a:b], minlength=256) for a, b in zip(off[:-1], off[1:])]).astype(np.float64)
    size = np.maximum(hist.sum(1), 1)
    share = {k: hist[:, list(v)].sum(1) / size for k, v in _CLASSES.items()}
    s, e, h, first = words(data, off, hasher)
    n_words = np.diff(first).astype(np.float64)
    per = np.maximum(n_words, 1)
    doc = np.repeat(np.arange(n), np.diff(first))
    mean = lambda x: np.bincount(doc, x, n) / per
    length = (e - s).astype(np.float64)
    order = np.lexsort((h, doc))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    p = hist / size[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    lines, marks = hist[:, 10] + 1, hist[:, [46, 33, 63]].sum(1) + 1
    cols = {"log_bytes": np.log1p(hist.sum(1)), "log_words": np.log1p(n_words), "word_length": mean(length),
            "long_words": mean(length > 12), "unique_words": mean_of(fresh, doc[order], n) / per,
            "repeated_next": mean(again), "top_gap": _gap(s, e, doc, n) / per, "words_per_line": n_words / lines,
            "words_per_mark": n_words / marks, "byte_entropy": entropy} | share
    return np.column_stack([cols[k] for k in FEATURES]).astype(np.float32)


def mean_of(flag, doc, n):
    return np.bincount(doc, flag, n)


def _gap(s, e, doc, n):
    """Words that stand more than one byte behind the word before them (marks or blanks between)."""
    far = np.zeros(len(s), bool)
    far[1:] = (s[1:] - e[:-1] > 1) & (doc[1:] == doc[:-1])
    return np.bincount(doc, far, n)


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, features`` for every document, from its whole text (null: empty)."""
    def run(batches):
        hasher = Hasher()
        for batch in batches:
            data, off = utf8(batch.column(1))
            parts = [features(data[off[i]:off[j]], off[i:j + 1] - off[i], hasher) for i, j in spans(off)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)), np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()),
                                             pa.array(x.ravel()))
            yield pa.record_batch([batch.column(0), lists], names=["doc_id", "features"])

    x = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("t"))
    return x.mapInArrow(run, "doc_id bigint, features array<float>")


# ---- the additive model ----------------------------------------------------------------------------------------

def _leaf_values(g: np.ndarray, h: np.ndarray, ridge: float, depth: int = 2) -> np.ndarray:
    """Values per bin of a shallow tree over ordered bins with gradient sums ``g`` and curvature sums ``h``."""
    if depth == 0 or len(g) < 2:
        return np.full(len(g), g.sum() / (h.sum() + ridge))
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = cg ** 2 / (ch + ridge) + (g.sum() - cg) ** 2 / (h.sum() - ch + ridge)
    cut = int(np.argmax(gain)) + 1
    return np.concatenate([_leaf_values(g[:cut], h[:cut], ridge, depth - 1),
                           _leaf_values(g[cut:], h[cut:], ridge, depth - 1)])


def _pair_values(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Values of a depth-2 tree over a bin grid: one row cut, then a column cut on each side; and its gain."""
    best, out = -1.0, np.zeros_like(g)
    rows_g, rows_h = np.cumsum(g, 0), np.cumsum(h, 0)
    for cut in range(1, len(g)):
        value, total = np.empty_like(g), 0.0
        for sl, cg, ch in ((slice(0, cut), rows_g[cut - 1], rows_h[cut - 1]),
                           (slice(cut, None), rows_g[-1] - rows_g[cut - 1], rows_h[-1] - rows_h[cut - 1])):
            v = _leaf_values(cg, ch, ridge, 1)
            value[sl] = v
            total += float((cg * v).sum())
        if total > best:
            best, out = total, value
    return out, best


class AdditiveModel:
    """Intercept, per-feature tables and pair tables."""

    def __init__(self, bins: int = 48, coarse: int = 8, cycles: int = 150, pair_cycles: int = 60, pairs: int = 6,
                 rate: float = 0.15, ridge: float = 5.0):
        self.bins, self.coarse, self.cycles, self.pair_cycles = bins, coarse, cycles, pair_cycles
        self.n_pairs, self.rate, self.ridge = pairs, rate, ridge

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> AdditiveModel:
        x = np.nan_to_num(np.asarray(x, np.float32))
        q = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], q)) if len(x) else np.zeros(0) for f in range(x.shape[1])]
        size = [len(e) + 1 for e in self.edges]
        self.tables = [np.zeros(s) for s in size]
        self.pair_at, self.pair_tables = [], []
        mean = float((weight * y).sum() / weight.sum()) if len(y) else 0.5
        mean = min(max(mean, 1e-3), 1 - 1e-3)
        self.intercept = float(np.log(mean / (1 - mean)))
        if not len(y) or y.min() == y.max():
            return self
        b = self._bin(x)
        score = np.full(len(y), self.intercept)

        def sums(idx, n):
            p = 1 / (1 + np.exp(-score))
            return np.bincount(idx, weight * (y - p), n), np.bincount(idx, weight * p * (1 - p), n)

        for _ in range(self.cycles):
            for f, n in enumerate(size):
                if n > 1:
                    step = self.rate * _leaf_values(*sums(b[:, f], n), self.ridge)
                    self.tables[f] += step
                    score += step[b[:, f]]
        c = (b * self.coarse) // np.array(size)
        k, gains = self.coarse, []
        for f in range(len(size)):
            for g in range(f + 1, len(size)):
                if size[f] > 1 and size[g] > 1:
                    s = sums(c[:, f] * k + c[:, g], k * k)
                    gains.append((_pair_values(s[0].reshape(k, k), s[1].reshape(k, k), self.ridge)[1], -f, -g))
        self.pair_at = [(-f, -g) for _, f, g in sorted(gains, reverse=True)[:self.n_pairs]]
        self.pair_tables = [np.zeros((k, k)) for _ in self.pair_at]
        for _ in range(self.pair_cycles):
            for t, (f, g) in zip(self.pair_tables, self.pair_at):
                at = c[:, f] * k + c[:, g]
                s = sums(at, k * k)
                step = self.rate * _pair_values(s[0].reshape(k, k), s[1].reshape(k, k), self.ridge)[0]
                t += step
                score += step.ravel()[at]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        x = np.nan_to_num(np.asarray(x, np.float32))
        b = self._bin(x)
        out = np.full(len(x), self.intercept)
        for f, t in enumerate(self.tables):
            out += t[b[:, f]]
        c = (b * self.coarse) // np.array([len(e) + 1 for e in self.edges])
        for t, (f, g) in zip(self.pair_tables, self.pair_at):
            out += t[c[:, f], c[:, g]]
        return 1 / (1 + np.exp(-out))


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """crc32 of the id's text falls in the held-out fold; a null id is held out too."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))


def label_sample(labels: DataFrame, label: str, folds: int, fold: int, per_class: int,
                 id_col: str = "doc_id") -> tuple[DataFrame, dict[int, int]]:
    """Learning rows: at most ``per_class`` ids of each class (smallest id hash first), and the class sizes.

    Rows with a null id or label and held-out ids are left out; an id with several labels takes the smallest."""
    y = F.col(f"`{label}`").cast("int")
    x = (labels.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), y.alias("y"))
         .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"), folds, fold))
         .groupBy("doc_id").agg(F.min("y").alias("y")))
    sizes = {r["y"]: r["n"] for r in x.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [x.filter(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return parts[0].unionByName(parts[1]), sizes


def class_weights(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that restore the class shares of all labelled rows in the sample."""
    w = np.ones(len(y))
    for c in (0, 1):
        n = int((y == c).sum())
        if n:
            w[y == c] = sizes.get(c, n) / n
    return w * (len(y) / max(w.sum(), 1e-9))


def fit_quality(table: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, fold: int = 1,
                per_class: int = 8000) -> AdditiveModel:
    """Fit on at most ``per_class`` labelled feature rows of each class (only those come to the driver)."""
    sample, sizes = label_sample(labels, label, folds, fold, per_class)
    rows = table.join(F.broadcast(sample), "doc_id").orderBy("doc_id", "features").limit(4 * per_class).toPandas()
    y = rows["y"].to_numpy(np.float64) if len(rows) else np.zeros(0)
    x = np.stack(rows["features"].to_list()) if len(rows) else np.zeros((0, len(FEATURES)), np.float32)
    return AdditiveModel().fit(x, y, class_weights(y, sizes))


def score_quality(table: DataFrame, model: AdditiveModel, folds: int = 3, fold: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of a feature table."""
    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.record_batch([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    out = table.mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
