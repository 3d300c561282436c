"""Retrieval queries: cosine top-k, TF-IDF top-k, two-stage retrieval, tournament rerank,
MAP@k, triplet mining, batch functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import retrieval as R
from .catalog import query, rounded, table
from .text_q import BLANKS, CLEAN_QUERY, CLEAN_SECOND

WORD = r"[\p{L}\p{N}_]"
K_VEC = 25


def _cos_sql(k: int) -> str:
    e = "CAST({t}.embedding AS DOUBLE[])"
    q, c = e.format(t="q"), e.format(t="c")
    return f"""WITH s AS (SELECT q.vec_id AS q_id, c.vec_id AS c_id, q.label AS q_label, c.label AS c_label,
  round(list_dot_product({q}, {c}) / (sqrt(list_dot_product({q}, {q})) * sqrt(list_dot_product({c}, {c}))), 6) AS score
  FROM embeddings q, embeddings c WHERE q.vec_id <> c.vec_id),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) AS INTEGER) AS rank
  FROM s) WHERE rank <= {k})"""


def _neighbours(spark, sf, k=K_VEC):
    e = table(spark, sf, "embeddings")
    return R.top_k(e, e, k, "vec_id", "vec_id", "embedding", exclude_self=True)


@query("cosine_top_k", "F15 J6 O2 W3", sql=_cos_sql(K_VEC) + " SELECT q_id, rank, c_id, score FROM top")
def cosine_top_k(spark, sf):
    return _neighbours(spark, sf)


@query("cosine_check", "F15", sql="""
SELECT q.vec_id AS a, c.vec_id AS b, round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[]))
  / (sqrt(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])))
     * sqrt(list_dot_product(CAST(c.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])))), 6) AS cosine,
  round(sqrt(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))), 6) AS norm_a
FROM embeddings q JOIN embeddings c ON c.vec_id = q.vec_id + 1""")
def cosine_check(spark, sf):
    """Column-expression cosine (F15) on consecutive vector pairs."""
    e = table(spark, sf, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), F.col("embedding").alias("eb"))
    j = e.select(F.col("vec_id").alias("a"), F.col("embedding").alias("ea")).join(nxt, "a")
    return rounded(j.select("a", "b", R.cosine("ea", "eb").alias("cosine"),
                            F.sqrt(R.dot("ea", "ea")).alias("norm_a")))


# ---------------------------------------------------------------- TF-IDF (M1 M2)


def _tfidf_sql(query_sql: str, k: int, name: str = "") -> str:
    """Oracle CTEs for TF-IDF cosine top-k; ``query_sql`` yields (id, text)."""
    p = name
    return f"""
{p}dt AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '{WORD}+')) AS tok FROM documents),
{p}dtf AS (SELECT id, tok, CAST(count(*) AS DOUBLE) AS tf FROM {p}dt GROUP BY id, tok),
{p}idf AS (SELECT tok, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM {p}dtf GROUP BY tok),
{p}dw AS (SELECT id, tok, tf * idf AS w FROM {p}dtf JOIN {p}idf USING (tok)),
{p}dn AS (SELECT id, tok, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {p}dw),
{p}qt AS (SELECT id, unnest(regexp_extract_all(lower(text), '{WORD}+')) AS tok FROM ({query_sql})),
{p}qtf AS (SELECT id, tok, CAST(count(*) AS DOUBLE) AS tf FROM {p}qt GROUP BY id, tok),
{p}qw AS (SELECT id, tok, tf * idf AS w FROM {p}qtf JOIN {p}idf USING (tok)),
{p}qn AS (SELECT id, tok, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {p}qw),
{p}sc AS (SELECT q.id AS q_id, d.id AS c_id, round(sum(q.w * d.w), 6) AS score FROM {p}qn q JOIN {p}dn d USING (tok)
  GROUP BY q.id, d.id),
{p}top AS (SELECT q_id, CAST(rank AS INTEGER) AS rank, c_id, score FROM (SELECT *, row_number() OVER
  (PARTITION BY q_id ORDER BY score DESC, c_id) AS rank FROM {p}sc) WHERE rank <= {k})"""


@query("text_top_k", "M1", sql="WITH " + _tfidf_sql("SELECT item_id AS id, text FROM benchmark", 10)
       + " SELECT * FROM top")
def text_top_k(spark, sf):
    return R.text_top_k(table(spark, sf, "benchmark"), table(spark, sf, "documents"), 10,
                        "item_id", "text", "doc_id", "text")


_FIRST = f"SELECT item_id AS id, {CLEAN_QUERY.format('text', BLANKS)} AS text FROM benchmark"
_ENRICHED = f"""SELECT b.item_id AS id, concat_ws(chr(10) || chr(10), h.fb, {CLEAN_SECOND.format('b.text', BLANKS)}) AS text
 FROM benchmark b LEFT JOIN
 (SELECT t.q_id, string_agg(d.text, ' ' ORDER BY t.rank) AS fb FROM s1top t JOIN documents d ON d.doc_id = t.c_id
  WHERE t.rank <= 1 GROUP BY t.q_id) h ON h.q_id = b.item_id"""


@query("two_stage", "M2 F3 F5 F9", sql="WITH " + _tfidf_sql(_FIRST, 100, "s1")
       + "," + _tfidf_sql(_ENRICHED, 25, "s2") + " SELECT * FROM s2top")
def two_stage(spark, sf):
    return R.two_stage(table(spark, sf, "benchmark"), table(spark, sf, "documents"), "item_id", "text",
                       "doc_id", "text", k1=100, k2=25, feedback=1)


# ---------------------------------------------------------------- rerank, MAP, triplets


def _ranked_lists(spark, sf):
    e = table(spark, sf, "embeddings")
    nb = _neighbours(spark, sf)
    lab = e.select(F.col("vec_id").alias("c_id"), F.col("label").alias("c_label"))
    ql = e.select(F.col("vec_id").alias("q_id"), F.col("label").alias("q_label"))
    j = nb.join(lab, "c_id").join(ql, "q_id")
    return j.groupBy("q_id", "q_label").agg(F.array_sort(F.collect_list(F.struct(
        "rank", F.col("c_id").alias("id"), "score", "c_label"))).alias("cands"))


@query("tournament", "M3 M4 F20", sql=_cos_sql(K_VEC) + """,
a AS (SELECT *, CAST(c_label = q_label AS INTEGER) AS agree FROM top),
w1 AS (SELECT q_id, first(c_id ORDER BY agree DESC, score DESC, c_id) AS w FROM a WHERE rank BETWEEN 17 AND 25 GROUP BY q_id),
w2 AS (SELECT a.q_id, first(a.c_id ORDER BY a.agree DESC, a.score DESC, a.c_id) AS w FROM a JOIN w1 USING (q_id)
  WHERE a.rank BETWEEN 9 AND 16 OR a.c_id = w1.w GROUP BY a.q_id),
w3 AS (SELECT a.q_id, first(a.c_id ORDER BY a.agree DESC, a.score DESC, a.c_id) AS w FROM a JOIN w2 USING (q_id)
  WHERE a.rank BETWEEN 1 AND 8 OR a.c_id = w2.w GROUP BY a.q_id)
SELECT a.q_id, w3.w AS winner, string_agg(CAST(a.c_id AS VARCHAR), ' ' ORDER BY CASE WHEN a.c_id = w3.w THEN 0 ELSE a.rank END)
  AS ranked FROM a JOIN w3 USING (q_id) GROUP BY a.q_id, w3.w""")
def tournament(spark, sf):
    lists = _ranked_lists(spark, sf)
    scorer = lambda x: F.struct((x["c_label"] == F.col("q_label")).cast("int").alias("agree"), x["score"])
    win = R.tournament(F.col("cands"), scorer, block=8, rounds=3)
    ids = F.transform("cands", lambda x: x["id"])
    out = lists.select("q_id", win["id"].alias("winner"), ids.alias("ids"))
    return out.select("q_id", "winner", F.array_join(F.transform(R.promote("ids", "winner"),
                                                                  lambda x: x.cast("string")), " ").alias("ranked"))


@query("promote", "M4 F20", sql=_cos_sql(K_VEC) + """,
w AS (SELECT q_id, coalesce(min(CASE WHEN c_label = q_label THEN rank END), 1) AS wr FROM top GROUP BY q_id),
wi AS (SELECT t.q_id, t.c_id AS winner FROM top t JOIN w ON w.q_id = t.q_id AND t.rank = w.wr)
SELECT t.q_id, wi.winner, string_agg(CAST(t.c_id AS VARCHAR), ' ' ORDER BY CASE WHEN t.c_id = wi.winner THEN 0 ELSE t.rank END)
  AS ranked FROM top t JOIN wi USING (q_id) GROUP BY t.q_id, wi.winner""")
def promote(spark, sf):
    """M4 alone: the best-ranked candidate whose label agrees with the query's (else the
    first) moves to the front; the others keep their order."""
    lists = _ranked_lists(spark, sf)
    agreeing = F.filter("cands", lambda x: x["c_label"] == F.col("q_label"))
    winner = F.coalesce(F.try_element_at(agreeing, F.lit(1))["id"], F.element_at("cands", 1)["id"])
    ids = F.transform("cands", lambda x: x["id"])
    out = lists.select("q_id", winner.alias("winner"), ids.alias("ids"))
    return out.select("q_id", "winner", F.array_join(F.transform(R.promote("ids", "winner"),
                                                                  lambda x: x.cast("string")), " ").alias("ranked"))


@query("map_at_k", "M5", sql=_cos_sql(K_VEC) + """,
f AS (SELECT q_id, q_label, c_label, min(rank) AS r FROM top GROUP BY q_id, q_label, c_label),
ap AS (SELECT q_id, q_label, coalesce(max(CASE WHEN c_label = q_label THEN 1.0 / r END), 0.0) AS ap FROM f GROUP BY q_id, q_label)
SELECT q_label, round(avg(ap), 6) AS map_at_25, count(*) AS n_queries FROM ap GROUP BY q_label""")
def map_at_k(spark, sf):
    lists = _ranked_lists(spark, sf).select("q_label", F.array("q_label").alias("actual"),
                                            F.transform("cands", lambda x: x["c_label"]).alias("predicted"))
    return rounded(M.map_at_k(lists, "actual", "predicted", 25, by=["q_label"]))


@query("triplets", "M15 U3 J2", sql=_cos_sql(K_VEC) + """
SELECT t.q_id AS vec_id, t.rank, 'vector ' || CAST(t.q_id AS VARCHAR) AS anchor, pp.p_name AS positive, pn.p_name AS negative
FROM top t JOIN part pp ON pp.p_partkey = t.q_label JOIN part pn ON pn.p_partkey = t.c_label
WHERE t.c_label <> t.q_label""")
def triplets(spark, sf):
    e = table(spark, sf, "embeddings")
    anchors = e.select("vec_id", F.col("label").cast("bigint").alias("label"),
                       F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("anchor_text"))
    lists = _ranked_lists(spark, sf).select(F.col("q_id").alias("vec_id"), "cands")
    retrieved = lists.select("vec_id", F.explode("cands").alias("c")).select(
        "vec_id", F.col("c.rank").alias("rank"), F.col("c.c_label").cast("bigint").alias("neg_id"))
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return R.mine_triplets(anchors, retrieved, names, "vec_id", "label", "anchor_text")


def _length_fn():
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": pdf["doc_id"], "n_chars": pdf["text"].str.len().astype("int64")})
    return fn


@query("batch_map", "X5 X7", sql="SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE length(text) > 100")
def batch_map(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    out = R.batch_map(d, _length_fn, "doc_id long, n_chars long", batch_rows=16)
    return out.filter(F.col("n_chars") > 100)
