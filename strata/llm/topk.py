"""Exact top-k search by inner product: columnar branch and bound.

Queries and candidates are hashed into blocks of bounded size and each pair of blocks is one task.  Inside a task the
candidates lie in vertical layout (one contiguous row per dimension).  Scores grow dimension block by dimension block;
after each block the mass that the remaining dimensions can still add (Cauchy-Schwarz on their norms) bounds every
candidate from both sides, and the candidates whose upper bound is below the k-th best lower bound are compacted away.
Only ``k`` rows per query and candidate block leave a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCHEMA = "query_id bigint, vec_id bigint, score bigint"


def _matrix(table: pa.Table, col: str, dims: int) -> np.ndarray:
    """Rows of an Arrow list<long> column as int64, padded with zeros to ``dims``."""
    arr = table.column(col).combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.list_(pa.int64()))
    out = np.zeros((len(arr), dims), np.int64)
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(np.asarray(arr.offsets))
    row = np.repeat(np.arange(len(arr)), size)
    col_at = np.arange(len(flat)) - np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    out[row, col_at] = flat
    return out


def _longest(table: pa.Table, col: str) -> int:
    import pyarrow.compute as pc

    return int(pc.max(pc.list_value_length(table.column(col))).as_py() or 0) if table.num_rows else 0


def branch_and_bound(q_ids, q, c_ids, c, k: int, dim_block: int):
    """Best ``k`` candidates of every query: lists of (query, candidate ids, scores).  ``q`` and ``c`` are int64."""
    dims = q.shape[1]
    peak = max(1, int(np.abs(q).max(initial=0))) * max(1, int(np.abs(c).max(initial=0))) * max(1, dims)
    kind = np.float64 if peak < 1 << 53 else np.int64  # sums below 2^53 are exact in doubles
    order = np.argsort(-(c.astype(np.float64) ** 2).sum(0), kind="stable")  # heavy dimensions first
    vert = np.ascontiguousarray(c[:, order].T.astype(kind))
    qs = np.ascontiguousarray(q[:, order].astype(kind))
    cuts = [(a, min(a + dim_block, dims)) for a in range(0, dims, dim_block)] or [(0, 0)]
    norm = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(-1))
    rest_c = [norm(vert[b:].T) for _, b in cuts]
    rest_q = [norm(qs[:, b:]) for _, b in cuts]
    for i in range(len(qs)):
        live = np.flatnonzero(c_ids != q_ids[i])
        score = np.zeros(len(live), kind)
        floor = -np.inf
        for t, (a, b) in enumerate(cuts):
            score = score + qs[i, a:b] @ (vert[a:b] if len(live) == len(c) else vert[a:b, live])
            spare = rest_q[t][i] * rest_c[t][live] * (1 + 1e-9) + 1e-6
            if len(live) > k:
                floor = max(floor, np.partition(score - spare, len(live) - k)[len(live) - k])
                keep = score + spare >= floor
                if not keep.all():
                    live, score = live[keep], score[keep]
        best = np.lexsort((c_ids[live], -score))[:k]
        yield q_ids[i], c_ids[live[best]], score[best].astype(np.int64)


def exact_top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "vec",
                query_rows: int = 1024, cand_rows: int = 16384, dim_block: int = 16) -> DataFrame:
    """For each query its ``k`` candidates of highest inner product, ties to the smaller id: columns
    ``query_id, rank (from 1), vec_id, score``.

    Vectors are ``array<bigint>``; a shorter vector counts as padded with zeros.  Rows with a null id, a null vector or
    a null component take no part.  A repeated id counts once (its smallest vector).  A query is never its own
    candidate.  Empty tables give no rows.  Scores must fit in 64 bits."""
    def side(df):
        x = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<bigint>").alias("v"))
        x = x.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda e: e.isNull()))
        return x.groupBy("id").agg(F.min("v").alias("v"))

    q, c = side(queries), side(candidates)
    n_q = max(1, -(-q.count() // query_rows))
    n_c = max(1, -(-c.count() // cand_rows))
    block = lambda n, salt: F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(n)).cast("int")
    q = q.select(F.col("id").alias("q_id"), "v", block(n_q, 1).alias("qb"),
                 F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("cb"))
    c = c.select(F.col("id").alias("c_id"), "v", block(n_c, 2).alias("cb"),
                 F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"))

    def local(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            dims = max(_longest(left, "v"), _longest(right, "v"))
            q_ids, c_ids = (t.column(n).to_numpy() for t, n in ((left, "q_id"), (right, "c_id")))
            for q_id, ids, scores in branch_and_bound(q_ids, _matrix(left, "v", dims), c_ids,
                                                      _matrix(right, "v", dims), k, dim_block):
                out[0].append(np.full(len(ids), q_id))
                out[1].append(ids)
                out[2].append(scores)
        cols = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in out]
        return pa.table(cols, names=["query_id", "vec_id", "score"])

    near = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(local, SCHEMA)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """Ids with ``floor(scale * x)`` of every component as bigint; vectors that are null or hold null or non-finite
    components are left out."""
    ok = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.filter(F.col(vec_col).isNotNull() & ok)
            .select(F.col(id_col).alias("vec_id"),
                    F.transform(vec_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vec")))
