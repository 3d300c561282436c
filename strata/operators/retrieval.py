"""Retrieval operators.  Ids: F15, J6, O2, W3, M1-M4, M15, X5.

All-pairs scoring (the reference's dense similarity matrix) is never materialised as
rows.  :func:`block_top_k` is a distributed block product:

* queries get a query block ``qb = pmod(xxhash64(id), QB)`` and are replicated to the
  ``CB`` corpus blocks; corpus rows get ``cb = pmod(xxhash64(id), CB)`` and are
  replicated to the ``QB`` query blocks - an equi-cogroup on ``(qb, cb)``, no cross join;
* each (qb, cb) group is scored with numpy inside one Arrow task (``applyInPandas``) and
  keeps only its local top-k per query;
* the global top-k per query is a ``row_number() <= k`` over at most ``CB * k``
  candidates per query (Spark plans it with a ``WindowGroupLimit``).

Shuffle volume is ``|Q| * CB + |C| * QB`` rows; block sizes bound the memory of a task, which scores
a block in pieces of ``SCORES``.
Ties: scores are rounded to 6 decimals, then the smaller corpus id wins.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import WORD, clean_query, clean_second
from ..session import materialised
from .joins import bucketed
from .schema import _q

# ---------------------------------------------------------------- F15 column functions


def dot(a, b) -> Column:
    """dot product of two numeric arrays (accumulated in double)."""
    a, b = _c(a), _c(b)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, x: acc + x)


def l2_normalize(a) -> Column:
    """vector divided by its L2 norm; the components of a zero vector become null."""
    a = _c(a)
    norm = F.sqrt(dot(a, a))
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), norm))


def cosine(a, b) -> Column:
    """cosine similarity of two arrays, null when either has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _c(x) -> Column:
    return F.col(_q(x)) if isinstance(x, str) else x


# ---------------------------------------------------------------- block top-k


SCORES = 1 << 20  # scores of one task that are held at once


def _local_top_k(q_ids: np.ndarray, c_ids: np.ndarray, scores: np.ndarray, k: int) -> pd.DataFrame:
    """Top-k per query row of a dense score block: (rounded score desc, corpus id asc)."""
    out_q, out_c, out_s = [], [], []
    rs = np.round(scores, 6)
    n = rs.shape[1]
    for i in range(rs.shape[0]):
        row = rs[i]
        if n > k:
            kth = np.partition(row, n - k)[n - k]
            cand = np.nonzero(row >= kth)[0]
        else:
            cand = np.arange(n)
        order = np.lexsort((c_ids[cand], -row[cand]))[:k]
        pick = cand[order]
        out_q.append(np.full(len(pick), q_ids[i]))
        out_c.append(c_ids[pick])
        out_s.append(rs[i, pick])
    if not out_q:
        return pd.DataFrame({"q_id": pd.Series([], dtype="int64"), "c_id": pd.Series([], dtype="int64"),
                             "score": pd.Series([], dtype="float64")})
    return pd.DataFrame({"q_id": np.concatenate(out_q).astype("int64"), "c_id": np.concatenate(out_c).astype("int64"),
                         "score": np.concatenate(out_s).astype("float64")})


def _blocks(n: int, per_block: int) -> int:
    return max(1, math.ceil(n / max(1, per_block)))


def block_top_k(queries: DataFrame, corpus: DataFrame, k: int,
                score_block: Callable[[pd.DataFrame, pd.DataFrame, int], pd.DataFrame],
                q_block_rows: int = 2048, c_block_rows: int = 20000, exclude_self: bool = False) -> DataFrame:
    """Generic exact top-k: ``queries`` and ``corpus`` have an ``id`` column (bigint) plus
    payload; ``score_block(qpdf, cpdf, k)`` returns the local top-k rows
    ``(q_id, c_id, score)``.  Returns ``(q_id, rank, c_id, score)`` with rank from 1.
    ``exclude_self`` drops the pair of an id with itself (queries drawn from the corpus):
    blocks keep k + 1 candidates so k remain."""
    local_k = k + 1 if exclude_self else k
    nq = queries.select("id").distinct().count()
    nc = corpus.count()
    QB, CB = _blocks(nq, q_block_rows), _blocks(nc, c_block_rows)
    # both sides must carry the block ids with the same type, or equal keys hash apart
    q = (queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(QB)).cast("int"))
         .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(CB - 1)))))
    c = (corpus.withColumn("cb", F.pmod(F.xxhash64("id"), F.lit(CB)).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(QB - 1)))))

    def run(qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(cpdf) == 0:
            return _local_top_k(np.array([]), np.array([]), np.zeros((0, 0)), k)
        return score_block(qpdf, cpdf, local_k)

    cands = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(
        run, "q_id long, c_id long, score double")
    if exclude_self:
        cands = cands.filter(F.col("q_id") != F.col("c_id"))
    rounded = cands  # blocks round scores once, the final order uses the same values
    w = Window.partitionBy("q_id").orderBy(F.desc("score"), F.asc("c_id"))
    return (rounded.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("q_id", "rank", "c_id", "score"))


def _dense_scores(qpdf: pd.DataFrame, cpdf: pd.DataFrame, k: int) -> pd.DataFrame:
    Q = np.stack(qpdf["vec"].to_numpy()).astype(np.float64)
    C = np.stack(cpdf["vec"].to_numpy()).astype(np.float64)
    nq, nc = np.linalg.norm(Q, axis=1), np.linalg.norm(C, axis=1)
    # a vector without length has no direction: as a query it finds nothing, as a candidate it is not found
    Q, C = Q[nq > 0] / nq[nq > 0, None], C[nc > 0] / nc[nc > 0, None]
    q_ids, c_ids = qpdf["id"].to_numpy()[nq > 0], cpdf["id"].to_numpy()[nc > 0]
    step = max(1, SCORES // max(1, len(c_ids)))  # the scores of a piece are all that a task holds
    return pd.concat([_local_top_k(q_ids[a:a + step], c_ids, Q[a:a + step] @ C.T, k) for a in range(0, max(1, len(q_ids)), step)],
                     ignore_index=True)


def top_k(queries: DataFrame, corpus: DataFrame, k: int, q_id: str, c_id: str, vec: str,
          q_vec: str | None = None, **block_opts) -> DataFrame:  # noqa: D417
    """O2: cosine top-k neighbours of every query in the corpus -> ``q_id, rank, c_id, score``."""
    q = queries.select(F.col(_q(q_id)).cast("bigint").alias("id"), F.col(_q(q_vec or vec)).alias("vec"))
    c = corpus.select(F.col(_q(c_id)).cast("bigint").alias("id"), F.col(_q(vec)).alias("vec"))
    return block_top_k(q, c, k, _dense_scores, **block_opts)


# ---------------------------------------------------------------- TF-IDF retrieval (M1 M2)


BUCKET_ROWS = 1 << 19  # rows of one bucket of posting lists
NEAR_ROWS = 1 << 19  # query tokens that every task may hold


def tokens(text) -> Column:
    """Word tokens of lower-cased text (Unicode letters, digits, underscore)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD + "+"), 0)


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, tok, tf): token counts per document (one explode, one partial+final aggregate)."""
    return (df.select(F.col(_q(key)).cast("bigint").alias("id"), F.explode(tokens(text)).alias("tok"))
            .groupBy("id", "tok").agg(F.count(F.lit(1)).cast("double").alias("tf")))


class Fitted(NamedTuple):
    """M1 fit of a corpus: token counts ``id, tok, tf``, ``tok, df, idf``, and each document's weight norm ``id, norm``."""

    tf: DataFrame
    idf: DataFrame
    norm: DataFrame


def tfidf_fit(corpus: DataFrame, key: str, text: str) -> Fitted:
    """M1 fit: tf = count of the token in the document; idf = ln((1 + N) / (1 + df)) + 1; norm = the length of tf * idf.

    The three tables are written once to the session's shared checkpoint folder, as tokenising is the costly step and
    all later steps read them; weights are not written, the lists of the tokens that queries hold are made from them."""
    tf = materialised(term_counts(corpus, key, text), "term-counts")
    n_docs = corpus.select(F.count(F.lit(1))).scalar()  # scalar subquery, computed once
    idf = materialised(tf.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
                       .select("tok", "df", (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf")), "idf")
    return Fitted(tf, idf, materialised(_norms(tf, idf), "norms"))


def _norms(tf: DataFrame, idf: DataFrame) -> DataFrame:
    w = F.col("tf") * F.col("idf")
    return tf.join(idf, "tok").groupBy("id").agg(F.sqrt(F.sum(w * w)).alias("norm"))


def _weights(tf: DataFrame, idf: DataFrame, norm: DataFrame) -> DataFrame:
    """The columns of both tables and ``w``, L2-normalised per document."""
    return tf.join(idf, "tok").join(norm, "id").withColumn("w", F.col("tf") * F.col("idf") / F.col("norm"))


def tfidf_query_weights(queries: DataFrame, key: str, text: str, idf: DataFrame) -> DataFrame:
    """M1 transform: query weights ``id, tok, w`` over the corpus vocabulary (unknown tokens ignored)."""
    tf = term_counts(queries, key, text)
    return _weights(tf, idf, _norms(tf, idf)).select("id", "tok", "w")


def text_top_k(queries: DataFrame, corpus: DataFrame, k: int, q_key: str, q_text: str, c_key: str,
               c_text: str, fitted: Fitted | None = None, seed_rows: int = 4096,
               list_rows: int = 1 << 20) -> DataFrame:
    """M1: TF-IDF cosine top-k (re-aimed from the neural encoder) -> ``q_id, rank, c_id, score``.  A query that shares no
    token with the corpus returns no row.  ``fitted`` takes the weights of an earlier :func:`tfidf_fit` over the same
    corpus.

    Posting lists of the query tokens, in joins and sums.  A query's rarest lists (about ``seed_rows`` rows) give partial
    scores, the k-th of which is a floor that the k-th full score cannot lie below.  A token adds at most its query weight
    times its list's greatest weight; the tokens whose such bounds together stay below the floor cannot lift a document to
    it alone, so their lists, the longest, are not read for candidates.  The other lists propose, a candidate that could
    not reach the floor even with all that is left is dropped, and the rest get their missing weights by (document,
    token).  Nothing is lost; scores are rounded to 6 decimals and ties go to the smaller id.  A list of more than
    ``list_rows`` documents is dealt over several keys by document.  The lists lie in buckets by document: where the
    query tokens are few (``NEAR_ROWS``), a document's sums are made in place and only those that reach the floor leave it."""
    fit = fitted or tfidf_fit(corpus, c_key, c_text)
    qw = materialised(tfidf_query_weights(queries, q_key, q_text, fit.idf), "query-weights")
    used = (fit.idf.join(qw.select("tok").distinct(), "tok", "left_semi")
            .withColumn("n", F.ceil(F.col("df") / list_rows).cast("int")))
    # bucketed by document, so that the sums of a document's weights need no exchange
    size = used.agg(F.sum("df")).first()[0] or 0
    buckets = min(4096, max(int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_ROWS)))
    lists = bucketed(_weights(fit.tf, used, fit.norm).select(
        "id", "tok", "w", F.pmod(F.xxhash64("id"), "n").cast("int").alias("part")), "id", buckets, "lists")
    top = lists.groupBy("tok").agg(F.max("w").alias("most"))
    rare = Window.partitionBy("q_id").orderBy("df", "tok").rowsBetween(Window.unboundedPreceding, -1)
    q = qw.select(F.col("id").alias("q_id"), "tok", F.col("w").alias("qw")).join(used, "tok").join(top, "tok")
    q = materialised(q.select("q_id", "tok", "qw", "n", (F.col("qw") * F.col("most")).alias("bound"),
                              F.coalesce(F.sum("df").over(rare), F.lit(0)).alias("before")), "query-tokens")

    few = q.agg(F.sum("n")).first()[0] or 0
    near = F.broadcast if few <= NEAR_ROWS else lambda x: x  # more query tokens: joined by token, with an exchange

    def partial(some: DataFrame) -> DataFrame:
        some = near(some.select("q_id", "tok", "qw", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part")))
        return (some.join(lists, ["tok", "part"]).groupBy("q_id", "id").agg(F.sum(F.col("qw") * F.col("w")).alias("s")))

    def floor(scores: DataFrame) -> DataFrame:
        best = Window.partitionBy("q_id").orderBy(F.desc("s"))
        return (scores.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k)
                .groupBy("q_id").agg((F.when(F.count(F.lit(1)) == k, F.min("s")).otherwise(0.0) - 2e-6).alias("floor")))

    low = floor(partial(q.filter(F.col("before") < seed_rows)))
    weak = Window.partitionBy("q_id").orderBy("bound", "tok")
    tokens_ = q.join(low, "q_id").withColumn("common", F.sum("bound").over(weak) < F.col("floor"))
    tokens_ = materialised(tokens_.select("q_id", "tok", "qw", "n", "bound", "floor", "common"), "token-kinds")
    strong = tokens_.filter("not common")
    spare = tokens_.groupBy("q_id").agg(F.max("floor").alias("floor"), F.coalesce(F.sum(F.when(F.col("common"), F.col("bound"))), F.lit(0.0)).alias("spare"))
    reach = lambda x, limits: (x.join(near(limits), "q_id").filter(F.col("s") + F.col("spare") >= F.col("floor"))
                               .select("q_id", "id", "s"))
    found = materialised(reach(partial(strong), spare), "candidates")
    spare = spare.join(floor(found).withColumnRenamed("floor", "floor2"), "q_id").select("q_id", F.greatest("floor", "floor2").alias("floor"), "spare")
    found = reach(found, spare)
    rest = (found.join(tokens_.filter("common").select("q_id", "tok", "qw"), "q_id").join(lists, ["id", "tok"])
            .groupBy("q_id", "id").agg(F.sum(F.col("qw") * F.col("w")).alias("more")))
    full = found.join(rest, ["q_id", "id"], "left").select(
        "q_id", F.col("id").alias("c_id"), F.round(F.col("s") + F.coalesce("more", F.lit(0.0)), 6).alias("score"))
    w = Window.partitionBy("q_id").orderBy(F.desc("score"), F.asc("c_id"))
    return (full.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("q_id", "rank", "c_id", "score"))


def two_stage(queries: DataFrame, corpus: DataFrame, q_key: str, q_text: str, c_key: str, c_text: str,
              k1: int = 100, k2: int = 25, feedback: int = 1) -> DataFrame:
    """M2: stage 1 top-``k1`` by the query text, cleaned by the query profile (F3); stage 2 top-``k2`` by the texts of its
    best ``feedback`` stage-1 hits (in rank order), an empty line and the query text cleaned by the second profile (F5).
    The corpus texts are taken as they are, and fitted once.  (The reference enriches with a language model's reply
    built from the stage-1 list; the model is not built, the hit texts take its place.)"""
    fitted = tfidf_fit(corpus, c_key, c_text)  # once for both stages
    asked = queries.select(F.col(_q(q_key)).cast("bigint").alias("__id"), clean_query(F.col(_q(q_text))).alias("__first"),
                           clean_second(F.col(_q(q_text))).alias("__second"))
    s1 = text_top_k(asked, corpus, k1, "__id", "__first", c_key, c_text, fitted=fitted)
    hits = (s1.filter(F.col("rank") <= feedback)
            .join(corpus.select(F.col(_q(c_key)).cast("bigint").alias("c_id"), F.col(_q(c_text)).alias("__t")), "c_id")
            .groupBy(F.col("q_id").alias("__id"))
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "__t"))),
                                          lambda s: s["__t"]), " ").alias("__fb")))
    enriched = asked.join(hits, "__id", "left").select("__id", F.concat_ws("\n\n", "__fb", "__second").alias("__text"))
    return text_top_k(enriched, corpus, k2, "__id", "__text", c_key, c_text, fitted=fitted)


# ---------------------------------------------------------------- rerank (M3 M4)


def tournament(cands: Column, scorer: Callable[[Column], Column], block: int = 8, rounds: int = 3) -> Column:
    """M3: knockout rerank over a ranked candidate array (best first, the first
    ``block*rounds+1`` items take part).  The survivor starts as the last item; each round
    shows the ``block`` items before the previous block plus the survivor and keeps the one
    with the highest ``scorer(candidate)`` (ties to the smaller ``id``).  Returns the winning
    candidate.  A shorter list plays the rounds its items reach; an empty one has no winner."""
    n = block * rounds + 1
    last = F.least(F.size(cands), F.lit(n))
    survivor = F.get(cands, last - 1)
    for r in range(rounds):
        start = n - block * (r + 1)
        length = F.greatest(F.least(last - start, F.lit(block)), F.lit(0))
        shown = F.concat(F.slice(cands, F.lit(start), length), F.array(survivor))
        best = F.array_max(F.transform(shown, lambda x: F.struct(scorer(x).alias("s"), (-x["id"]).alias("t"),
                                                                 x.alias("c"))))
        survivor = best["c"]
    return survivor


def promote(ids, winner) -> Column:
    """M4: winner first, the other ids in their old order."""
    return F.concat(F.array(_c(winner)), F.array_remove(_c(ids), _c(winner)))


# ---------------------------------------------------------------- triplets


def mine_triplets(anchors: DataFrame, retrieved: DataFrame, names: DataFrame, anchor_key: str,
                  positive_id: str, anchor_text: str) -> DataFrame:
    """Anchors with a label (``positive_id``) x their retrieved ids -> (anchor,
    positive, negative) texts; rows whose negative equals the positive are dropped.
    ``retrieved`` is long (``anchor_key, rank, neg_id``); ``names`` is ``(id, name)``."""
    lab = anchors.filter(F.col(_q(positive_id)).isNotNull())
    pos = names.select(F.col("id").alias(positive_id), F.col("name").alias("positive"))
    neg = names.select(F.col("id").alias("neg_id"), F.col("name").alias("negative"))
    return (lab.join(retrieved, anchor_key).join(pos, positive_id).join(neg, "neg_id")
            .filter(F.col("neg_id") != F.col(_q(positive_id)))
            .select(_q(anchor_key), "rank", F.col(_q(anchor_text)).alias("anchor"), "positive", "negative"))


# ---------------------------------------------------------------- batch functions


def batch_map(df: DataFrame, make_fn: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str,
              batch_rows: int = 16) -> DataFrame:
    """Apply a user batch function (e.g. an encoder or a generator) to Arrow batches
    of ``batch_rows`` rows.  ``make_fn`` runs once per task (load the model there)."""

    def run(it):
        fn = make_fn()
        for pdf in it:
            for s in range(0, len(pdf), batch_rows):
                yield fn(pdf.iloc[s:s + batch_rows])

    return df.mapInPandas(run, schema)
