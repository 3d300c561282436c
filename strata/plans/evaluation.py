"""Evaluation, ensembling and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C
from ..operators import metrics as M
from ..operators import model as ML
from ..operators import sampling as SP
from .catalog import query, rounded, table

# ---------------------------------------------------------------- M6


def _loss_input(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    n = F.col("n_chars")
    df = d.select("doc_id", (F.col("quality") + F.col("toxic")).alias("label"),
                  (F.log(1 + n) / 10).alias("l0"), ((n % 7) / 3).alias("l1"), ((n % 5) / 2).alias("l2"))
    return C.fill_sentinel(df, -100, ["label"])


_LOSS_SQL = """WITH d AS (SELECT coalesce(l.quality + l.toxic, -100) AS label, ln(1 + n_chars) / 10 AS l0,
  (n_chars % 7) / 3 AS l1, (n_chars % 5) / 2 AS l2 FROM documents LEFT JOIN labels l USING (doc_id)),
s AS (SELECT label, exp(l0 - greatest(l0, l1, l2)) AS e0, exp(l1 - greatest(l0, l1, l2)) AS e1,
  exp(l2 - greatest(l0, l1, l2)) AS e2 FROM d),
p AS (SELECT label, CASE label WHEN 0 THEN e0 WHEN 1 THEN e1 WHEN 2 THEN e2 END / (e0 + e1 + e2) AS p,
  CASE label WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 WHEN 2 THEN 4.0 ELSE 0.0 END AS w FROM s)
SELECT round(sum(CASE WHEN w > 0 THEN w * -ln(least(greatest(p, 1e-15), 1 - 1e-15)) ELSE 0 END) / sum(w), 6) AS log_loss,
  CAST(sum(CAST(w > 0 AS BIGINT)) AS BIGINT) AS n_used FROM p"""


@query("log_loss", "M6 P17", sql=_LOSS_SQL)
def log_loss(spark, sf):
    return rounded(M.weighted_log_loss(_loss_input(spark, sf), "label", ["l0", "l1", "l2"]))


@query("log_loss_baseline", "M6", sql="""
SELECT round(ln(3), 6) AS log_loss, CAST(count(*) AS BIGINT) AS n_used FROM documents JOIN labels USING (doc_id)""")
def log_loss_baseline(spark, sf):
    return rounded(M.constant_baseline(_loss_input(spark, sf), "label"))


# ---------------------------------------------------------------- M7 M8

_WEEK = "CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS BIGINT)"
_AUC_SQL = f"""e AS (SELECT {_WEEK} AS week, CAST(event_type = 'purchase' AS INTEGER) AS y, value FROM events),
pr AS (SELECT p.week, sum(CASE WHEN p.value > n.value THEN 1.0 WHEN p.value = n.value THEN 0.5 ELSE 0 END) AS wins
  FROM e p JOIN e n ON p.week = n.week AND p.y = 1 AND n.y = 0 GROUP BY p.week),
c AS (SELECT week, sum(y) AS n_pos, sum(1 - y) AS n_neg FROM e GROUP BY week),
auc AS (SELECT c.week, CASE WHEN n_pos > 0 AND n_neg > 0 THEN coalesce(pr.wins, 0) / (n_pos * n_neg) END AS auc,
  CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM c LEFT JOIN pr USING (week))"""


def _auc_input(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7).alias("week"),
                    (F.col("event_type") == "purchase").cast("int").alias("y"), "value")


@query("auc_by", "M7 X4", sql=f"WITH {_AUC_SQL} SELECT week, round(auc, 6) AS auc, n_pos, n_neg FROM auc")
def auc_by(spark, sf):
    return rounded(M.auc_by(_auc_input(spark, sf), "y", "value", ["week"]))


@query("gini_stability", "M8", sql=f"""WITH {_AUC_SQL},
g AS (SELECT week, 2 * auc - 1 AS gini, CAST(row_number() OVER (ORDER BY week) - 1 AS DOUBLE) AS x FROM auc WHERE auc IS NOT NULL),
f AS (SELECT avg(gini) AS mean_gini, regr_slope(gini, x) AS slope, regr_intercept(gini, x) AS intercept, count(*) AS n FROM g),
r AS (SELECT stddev_pop(g.gini - (f.slope * g.x + f.intercept)) AS res_std FROM g, f)
SELECT round(mean_gini + 88 * least(0, slope) - 0.5 * res_std, 6) AS stability, round(mean_gini, 6) AS mean_gini,
  round(slope, 6) AS slope, round(res_std, 6) AS res_std, CAST(n AS BIGINT) AS n_weeks FROM f, r""")
def gini_stability(spark, sf):
    return rounded(M.gini_stability(_auc_input(spark, sf), "week", "y", "value"))


# ---------------------------------------------------------------- M9


@query("blend", "M9", sql="""
SELECT c_custkey, round(0.5 * (c_acctbal / 10000) + 0.25 * (c_nationkey / 25) + 0.25 * ((c_custkey % 100) / 100), 8) AS score
FROM customer""")
def blend(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 10000).alias("s1"), (F.col("c_nationkey") / 25).alias("s2"),
        ((F.col("c_custkey") % 100) / 100).alias("s3"))
    return rounded(M.blend(c, {"s1": 0.5, "s2": 0.25, "s3": 0.25}).select("c_custkey", "score"), 8)


# ---------------------------------------------------------------- M10-M14


@query("split_ids", "M10 O4", sql="""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('1:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS r,
  count(*) OVER () AS n FROM orders),
c AS (SELECT *, floor(n * 0.6) AS n1 FROM r)
SELECT o_orderkey, CASE WHEN r < n1 THEN 'train' WHEN r < n1 + floor((n - n1) * 0.5) THEN 'valid' ELSE 'test' END AS split
FROM c""")
def split_ids(spark, sf):
    return SP.split_ids(table(spark, sf, "orders"), "o_orderkey", (0.6, 0.2, 0.2), seed=1)


@query("kfold", "M11 W6", sql="""
SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS INTEGER) AS fold
FROM orders""")
def kfold(spark, sf):
    return SP.kfold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5, seed=42)


@query("stratified_kfold", "M12", sql="""
SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id)
  - 1) % 10 AS INTEGER) AS fold FROM labels""")
def stratified_kfold(spark, sf):
    return SP.stratified_kfold(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", 10, seed=42)


@query("group_kfold", "M14 J5", sql="""
WITH u AS (SELECT user_id, CAST(ntile(5) OVER (ORDER BY md5('42:' || CAST(user_id AS VARCHAR)), user_id) - 1 AS INTEGER) AS fold
           FROM (SELECT DISTINCT user_id FROM events))
SELECT e.user_id, e.event_id, u.fold FROM events e JOIN u USING (user_id)""")
def group_kfold(spark, sf):
    return SP.group_kfold(table(spark, sf, "events").select("user_id", "event_id"), "user_id", 5, seed=42)


_SNAKE = """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
m AS (SELECT user_id, sum(n) AS size, (list(event_type ORDER BY n DESC, event_type))[1] AS main FROM c GROUP BY user_id),
r AS (SELECT user_id, (row_number() OVER (PARTITION BY main ORDER BY size DESC, md5(CAST(user_id AS VARCHAR)), user_id) - 1) % 10 AS place FROM m),
f AS (SELECT user_id, CAST(CASE WHEN place < 5 THEN place ELSE 9 - place END AS INTEGER) AS fold FROM r)"""


@query("stratified_group_kfold", "M13", sql=f"{_SNAKE} SELECT event_id, user_id, event_type, fold FROM events JOIN f USING (user_id)")
def stratified_group_kfold(spark, sf):
    """Whole users in one fold, event-type shares balanced by the snake rule."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return SP.stratified_group_kfold(e, "user_id", "event_type", 5)


@query("stratified_group_kfold_check", "M13", sql=f"""{_SNAKE}
SELECT event_type, fold, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events JOIN f USING (user_id)
GROUP BY event_type, fold""")
def stratified_group_kfold_check(spark, sf):
    """Class balance of M13: rows and users per (class, fold)."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    f = SP.stratified_group_kfold(e, "user_id", "event_type", 5)
    return f.groupBy("event_type", "fold").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_users"))


@query("group_kfold_null", "M14 M13", sql="""
SELECT count(*) AS n_rows, count(*) AS with_fold, count(DISTINCT toxic) + max(CAST(toxic IS NULL AS INTEGER)) AS n_groups
FROM documents LEFT JOIN labels USING (doc_id)""")
def group_kfold_null(spark, sf):
    """M14 and M13 on a nullable group: the rows of the null group stay."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", "toxic", "lang")
    g = SP.group_kfold(SP.stratified_group_kfold(d, "toxic", "lang", 5, alias="sfold"), "toxic", 2)
    return g.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.col("fold") + F.col("sfold")).alias("with_fold"),
                 (F.count_distinct("toxic") + F.max(F.col("toxic").isNull().cast("int"))).alias("n_groups"))


@query("auc_null_group", "M7", sql="""
WITH d AS (SELECT toxic AS g, CAST(n_chars % 2 AS INTEGER) AS y, CAST(n_chars % 97 AS DOUBLE) AS s
           FROM documents LEFT JOIN labels USING (doc_id)),
r AS (SELECT *, rank() OVER (PARTITION BY g ORDER BY s) + (count(*) OVER (PARTITION BY g, s) - 1) / 2.0 AS rk FROM d)
SELECT g, round((sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 6) AS auc,
  CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg FROM r GROUP BY g""")
def auc_null_group(spark, sf):
    """M7 on a nullable group."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select(
        F.col("toxic").alias("g"), (F.col("n_chars") % 2).cast("int").alias("y"),
        (F.col("n_chars") % 97).cast("double").alias("s"))
    return rounded(M.auc_by(d, "y", "s", ["g"]))


@query("gbt_folds", "M16 M9 P11", sql="""
SELECT doc_id, CAST(ntile(3) OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS INTEGER) AS fold,
  true AS is_probability, true AS own_model, true AS kept_trees FROM documents JOIN labels USING (doc_id)""")
def gbt_folds(spark, sf):
    """Per-fold GBT on document features (label = quality) with early stopping on the held-out fold.  Invariants, as GBT
    numbers are no one else's: every row is scored once, with a probability, by the model that was not trained on its
    fold (folds are 1 to 3), and that model kept 1 to 10 trees."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    feats = d.select("doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("chars_A"),
                     F.length("text").cast("double").alias("len_A"), F.col("lang").alias("lang_M"),
                     F.col("source").alias("source_M"))
    folded = SP.kfold(feats, "doc_id", 3, seed=42).withColumn("fold", F.col("fold") + 1)
    models = ML.fit_folds(folded, ["chars_A", "len_A"], ["lang_M", "source_M"], "label", "fold", max_iter=10, early_stop=True)
    scored = ML.score_folds(models, folded, "doc_id", fold="fold")
    kept = F.coalesce(*[F.when(F.col("fold") == m.fold, F.lit(1 <= m.trees <= 10)) for m in models])
    return scored.select("doc_id", "fold", F.col("score").between(0, 1).alias("is_probability"),
                         F.col("fold").isin([m.fold for m in models]).alias("own_model"), kept.alias("kept_trees"))


@query("target_stats", "M16 P11", sql="""
WITH d AS (SELECT doc_id, lang, source, CAST(quality AS DOUBLE) AS y, md5('42:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents JOIN labels USING (doc_id)), p AS (SELECT avg(y) AS prior FROM d)
SELECT doc_id, round((coalesce(sum(y) OVER l, 0) + prior) / (count(*) OVER l + 1), 9) AS lang_ts,
  round((coalesce(sum(y) OVER s, 0) + prior) / (count(*) OVER s + 1), 9) AS source_ts FROM d, p
WINDOW l AS (PARTITION BY lang ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  s AS (PARTITION BY source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def target_stats(spark, sf):
    """Ordered target statistics of language and source, for boosters that take levels as numbers."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id")
    out = ML.ordered_target_stats(d, ["lang", "source"], "quality", "doc_id", seed=42)
    return rounded(out.select("doc_id", "lang_ts", "source_ts"), 9)
