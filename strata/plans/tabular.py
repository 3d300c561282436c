"""Tabular queries: encodings, value maps, column rules, joins, reports, per-group
scaling, completeness, positions and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import columns as C
from ..operators import encode as E
from ..operators import joins as J
from ..operators import schema as S
from ..operators import windows as W
from .catalog import query, rounded, table

# ---------------------------------------------------------------- encodings

BAND = "CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR)"
_DICT_SQL = f"""
fit AS (SELECT c_mktsegment, {BAND} AS bal_band FROM customer WHERE c_acctbal < 5000),
long AS (SELECT DISTINCT 'c_mktsegment' AS "column", c_mktsegment AS value FROM fit
         UNION SELECT DISTINCT 'bal_band', bal_band FROM fit),
coded AS (SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
          FROM long),
dict AS (SELECT * FROM coded UNION ALL SELECT "column", 'Unknown', CAST(count(*) AS INTEGER) FROM coded GROUP BY "column")"""


def _customer_cats(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", "c_mktsegment", "c_acctbal",
                    F.floor(F.col("c_acctbal") / 1000).cast("string").alias("bal_band"))


@query("encode", "P11", sql=f"WITH {_DICT_SQL} SELECT * FROM dict")
def encode_q(spark, sf):
    c = _customer_cats(spark, sf)
    return E.fit_dictionary(c.filter(F.col("c_acctbal") < 5000), ["c_mktsegment", "bal_band"])


@query("align_categories", "P12 P11", sql=f"""
WITH {_DICT_SQL},
app AS (SELECT c_custkey, c_mktsegment, c_acctbal, {BAND} AS bal_band FROM customer WHERE c_acctbal >= 5000),
al AS (SELECT a.c_custkey, a.c_acctbal,
  CASE WHEN a.c_mktsegment IS NULL THEN 'Missing' WHEN d1.value IS NULL THEN 'Unknown' ELSE a.c_mktsegment END AS c_mktsegment,
  d1.code AS k1,
  CASE WHEN a.bal_band IS NULL THEN 'Missing' WHEN d2.value IS NULL THEN 'Unknown' ELSE a.bal_band END AS bal_band,
  d2.code AS k2
  FROM app a LEFT JOIN dict d1 ON d1."column" = 'c_mktsegment' AND d1.value = a.c_mktsegment
  LEFT JOIN dict d2 ON d2."column" = 'bal_band' AND d2.value = a.bal_band)
SELECT al.c_custkey, al.c_acctbal, al.c_mktsegment, al.bal_band,
  coalesce(al.k1, u1.code, -1) AS c_mktsegment_code, coalesce(al.k2, u2.code, -1) AS bal_band_code
FROM al LEFT JOIN dict u1 ON u1."column" = 'c_mktsegment' AND u1.value IN ('Unknown', 'Missing') AND u1.value = al.c_mktsegment
LEFT JOIN dict u2 ON u2."column" = 'bal_band' AND u2.value IN ('Unknown', 'Missing') AND u2.value = al.bal_band""")
def align_categories_q(spark, sf):
    c = _customer_cats(spark, sf)
    d = E.fit_dictionary(c.filter(F.col("c_acctbal") < 5000), ["c_mktsegment", "bal_band"])
    return E.align_categories(c.filter(F.col("c_acctbal") >= 5000), d, ["c_mktsegment", "bal_band"])


@query("new_categories", "T2", sql=f"""
SELECT DISTINCT {BAND} AS bal_band FROM customer WHERE c_acctbal >= 5000
EXCEPT SELECT DISTINCT {BAND} FROM customer WHERE c_acctbal < 5000""")
def new_categories_q(spark, sf):
    c = _customer_cats(spark, sf)
    return E.new_categories(c.filter(F.col("c_acctbal") >= 5000), c.filter(F.col("c_acctbal") < 5000), "bal_band")


# ---------------------------------------------------------------- values

@query("clean_values", "P13 P17", sql="""
WITH r AS (SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN 'inf'::DOUBLE
  WHEN event_type = 'click' THEN 'nan'::DOUBLE WHEN event_type = 'signup' THEN '-inf'::DOUBLE ELSE value END AS raw
  FROM events)
SELECT event_id, event_type, CASE WHEN isnan(raw) OR isinf(raw) THEN NULL ELSE raw END AS cleaned,
  CASE WHEN isnan(raw) OR isinf(raw) THEN -1.0 ELSE raw END AS filled FROM r""")
def clean_values(spark, sf):
    e = table(spark, sf, "events")
    raw = (F.when(F.col("event_type") == "error", F.lit(float("inf")))
           .when(F.col("event_type") == "click", F.lit(float("nan")))
           .when(F.col("event_type") == "signup", F.lit(float("-inf"))).otherwise(F.col("value")))
    df = e.select("event_id", "event_type", raw.alias("cleaned"))
    df = S.clean_non_finite(df, ["cleaned"])
    return C.fill_sentinel(df.withColumn("filled", F.col("cleaned")), -1.0, ["filled"])


@query("fill_map", "P18 P17", sql="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
  ELSE -100 END AS severity, o_orderpriority AS raw FROM orders""")
def fill_map(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("severity"),
                                          F.col("o_orderpriority").alias("raw"))
    # The three-level severity map of the reference (Normal/Mild, Moderate,
    # Severe -> 0, 1, 2), here on the first three priorities; others are unlabelled.
    m = C.map_values(o, ["severity"], {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}, on_missing="null",
                     out_type="int")
    return C.fill_sentinel(m, -100, ["severity"])


@query("pick_by_key", "P20", sql="""
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN CAST(o_custkey AS DOUBLE)
  WHEN 'P' THEN CAST(o_orderkey AS DOUBLE) END AS picked FROM orders""")
def pick_by_key_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"),
                                          F.col("o_custkey").cast("double").alias("cust"),
                                          F.col("o_orderkey").cast("double").alias("key"))
    return C.pick_by_key(o, "o_orderstatus", {"F": "price", "O": "cust", "P": "key"}).drop("price", "cust", "key")


# ---------------------------------------------------------------- column rules

@query("select_rules", "P6 P7 P8 P19 P21 P24", sql="""
SELECT CAST(c_custkey AS INTEGER) AS Predictcase_id, c_mktsegment AS Predictsegment_M,
  c_nationkey AS Predictnation_L, CAST(c_acctbal AS REAL) AS Predictacctbal_A FROM customer""")
def select_rules(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("case_id"), F.col("c_acctbal").alias("acctbal_A"),
        F.col("c_nationkey").alias("nation_L"), F.col("c_mktsegment").alias("segment_M"),
        (F.col("c_acctbal") * 2).alias("acctbal_A_max"), F.col("c_name").alias("name_M"),
        F.col("c_mktsegment").alias("person_housetype"), F.lit("2024-01-01").cast("date").alias("open_D"))
    x = S.select_by_name(c, S.is_model_column, keep=["case_id"])
    x = S.drop_columns(x, ["name_M", "not_there_M"])
    x = S.cast_wide_types(x, drop_dates=True)
    _, feats = C.split_features(x, label="target", key="case_id", group="WEEK_NUM")
    x = S.align_to(feats, ["case_id", "segment_M", "nation_L", "acctbal_A"])
    return S.prefix_columns(x, "Predict")


# ---------------------------------------------------------------- sampling order

@query("sample_n", "P22", sql="""
SELECT event_id, user_id, value FROM events ORDER BY md5('7:' || CAST(event_id AS VARCHAR)), event_id LIMIT 100""")
def sample_n_q(spark, sf):
    return C.sample_n(table(spark, sf, "events"), 100, 7, "event_id").select("event_id", "user_id", "value")


@query("shuffle", "O4", sql="""
SELECT user_id, row_number() OVER (ORDER BY md5('3:' || CAST(user_id AS VARCHAR)), user_id) - 1 AS position
FROM (SELECT DISTINCT user_id FROM events)""")
def shuffle_q(spark, sf):
    users = table(spark, sf, "events").select("user_id").distinct()
    return W.seeded_rank(users, "user_id", 3, alias="position")


# ---------------------------------------------------------------- joins

@query("join_suffix", "J1", sql="""
WITH s AS (SELECT s_nationkey AS nationkey, max(s_name) AS name, round(avg(s_acctbal), 6) AS acctbal, count(*) AS n_supp
           FROM supplier GROUP BY s_nationkey)
SELECT c.c_nationkey AS nationkey, c.c_name AS name, c.c_acctbal AS acctbal, s.name AS name_0, s.acctbal AS acctbal_0,
  s.n_supp, n.n_name AS name_1, n.n_regionkey AS regionkey
FROM customer c LEFT JOIN s ON s.nationkey = c.c_nationkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def join_suffix(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"),
                                               F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    supp = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.max("s_name").alias("name"), F.round(F.avg("s_acctbal"), 6).alias("acctbal"),
        F.count(F.lit(1)).alias("n_supp"))
    nat = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"),
                                            F.col("n_regionkey").alias("regionkey"))
    return J.join_all(cust, [supp, nat], on="nationkey")


@query("assign_by_key", "J4", sql="""
SELECT o.o_orderkey AS case_id, round(s.score, 4) AS score
FROM orders o LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS score FROM lineitem
                         WHERE l_returnflag = 'R' GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey""")
def assign_by_key_q(spark, sf):
    template = table(spark, sf, "orders").select(F.col("o_orderkey").alias("case_id"))
    scores = (table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
              .groupBy(F.col("l_orderkey").alias("case_id"))
              .agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("score")))
    return J.assign_by_key(template, scores, "case_id")


@query("semi", "J5", sql="""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def semi_q(spark, sf):
    ids = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return J.semi(table(spark, sf, "customer").select("c_custkey", "c_name"), ids, "c_custkey")


@query("anti", "J5", sql="""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def anti_q(spark, sf):
    ids = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return J.anti(table(spark, sf, "customer").select("c_custkey", "c_name"), ids, "c_custkey")


@query("join_multi", "J2 J3", sql="""
WITH ps AS (SELECT l_partkey, l_suppkey, count(*) AS n_ps, round(avg(l_quantity), 6) AS avg_qty_ps FROM lineitem
            GROUP BY l_partkey, l_suppkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, c.c_mktsegment, ps.n_ps, ps.avg_qty_ps
FROM lineitem l JOIN ps ON ps.l_partkey = l.l_partkey AND ps.l_suppkey = l.l_suppkey
JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey""")
def join_multi(spark, sf):
    li = table(spark, sf, "lineitem")
    ps = li.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n_ps"),
                                                  F.round(F.avg("l_quantity"), 6).alias("avg_qty_ps"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return (li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
            .join(ps, ["l_partkey", "l_suppkey"]).join(o, "l_orderkey").join(c, "c_custkey").drop("c_custkey"))


@query("pairs", "J7 T3", sql="""
SELECT a, row_number() OVER (ORDER BY a) - 1 AS rank, count(*) OVER () - (row_number() OVER (ORDER BY a) - 1) AS n_partners
FROM (SELECT DISTINCT p_size AS a FROM part)""")
def pairs(spark, sf):
    return J.distinct_value_pairs(table(spark, sf, "part"), "p_size")


@query("lookup_or", "J9", sql="""
WITH d AS (SELECT n_nationkey AS nk, 1 AS serial, n_name AS label FROM nation
           UNION ALL SELECT n_nationkey, 2, lower(n_name) FROM nation WHERE n_regionkey < 2),
c AS (SELECT c_custkey, c_nationkey + 3 AS nk, CAST(1 + c_custkey % 2 AS INTEGER) AS serial FROM customer)
SELECT c.c_custkey, c.nk, c.serial, coalesce(h.label, f.label, 'UNKNOWN') AS label
FROM c LEFT JOIN d h ON h.nk = c.nk AND h.serial = c.serial LEFT JOIN d f ON f.nk = c.nk AND f.serial = 1""")
def lookup_or_q(spark, sf):
    n = table(spark, sf, "nation")
    d = n.select(F.col("n_nationkey").alias("nk"), F.lit(1).alias("serial"), F.col("n_name").alias("label")).unionByName(
        n.filter(F.col("n_regionkey") < 2).select(F.col("n_nationkey").alias("nk"), F.lit(2).alias("serial"),
                                                  F.lower("n_name").alias("label")))
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") + 3).alias("nk"),
                                            (1 + F.col("c_custkey") % 2).cast("int").alias("serial"))
    return J.lookup_or(c, d, ["nk", "serial"], "label", fallback_keys={"serial": 1}, default="UNKNOWN")


@query("missing_combos", "J10", sql="""
SELECT u.user_id, t.day FROM (SELECT DISTINCT user_id FROM events) u
CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) t
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND CAST(e.ts AS DATE) = t.day)""")
def missing_combos_q(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"))
    return J.missing_combos(e, "user_id", "day")


# ---------------------------------------------------------------- required fields

@query("require_fields", "P23 P15 P16", sql="""
SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL AND d.lang IN ('en', 'de') AND d.source <> 'src0'
  AND l.quality <> l.toxic""")
def require_fields_q(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left") \
        .select("doc_id", "lang", "source", "quality", "toxic")
    r = C.require_fields(d, ["quality", "toxic"])
    return r.filter(F.col("lang").isin("en", "de") & (F.col("source") != "src0") & (F.col("quality") != F.col("toxic")))


# ---------------------------------------------------------------- reports

@query("value_counts", "A9", sql="SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def value_counts_q(spark, sf):
    return A.value_counts(table(spark, sf, "events"), "event_type")


@query("distinct_rows", "A10", sql="SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, sf):
    return table(spark, sf, "events").dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")


@query("global_stats", "A8", sql="""
SELECT CAST(min(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7)) AS BIGINT) AS min_week,
  CAST(max(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7)) AS BIGINT) AS max_week,
  round(avg(CAST(props IS NULL AS DOUBLE)), 6) AS null_share_props, count(DISTINCT user_id) AS n_users,
  count(*) AS n_rows FROM events""")
def global_stats(spark, sf):
    e = table(spark, sf, "events")
    wk = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7)
    return e.agg(F.min(wk).alias("min_week"), F.max(wk).alias("max_week"),
                 F.round(F.avg(F.col("props").isNull().cast("double")), 6).alias("null_share_props"),
                 F.count_distinct("user_id").alias("n_users"), F.count(F.lit(1)).alias("n_rows"))


@query("profile", "A12", sql="""
WITH p AS (SELECT * FROM part)
SELECT 'p_size' AS "column", 'int' AS dtype, count(p_size) AS non_null, round(avg(p_size), 6) AS mean,
  round(stddev_samp(p_size), 6) AS std, CAST(min(p_size) AS DOUBLE) AS min,
  round(quantile_cont(p_size, 0.25), 6) AS p25, round(quantile_cont(p_size, 0.5), 6) AS p50,
  round(quantile_cont(p_size, 0.75), 6) AS p75, CAST(max(p_size) AS DOUBLE) AS max FROM p
UNION ALL SELECT 'p_retailprice', 'double', count(p_retailprice), round(avg(p_retailprice), 6),
  round(stddev_samp(p_retailprice), 6), min(p_retailprice), round(quantile_cont(p_retailprice, 0.25), 6),
  round(quantile_cont(p_retailprice, 0.5), 6), round(quantile_cont(p_retailprice, 0.75), 6), max(p_retailprice) FROM p
UNION ALL SELECT 'p_brand', 'string', count(p_brand), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM p""")
def profile_q(spark, sf):
    return rounded(A.profile(table(spark, sf, "part"), ["p_size", "p_retailprice", "p_brand"]))


@query("weekly_mean", "A11", sql="""
WITH w AS (SELECT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS BIGINT) AS week,
  CAST(event_type = 'purchase' AS INTEGER) AS y FROM events)
SELECT week, round(avg(y), 6) AS mean, count(y) AS n, round(stddev_samp(y), 6) AS std,
  round(avg(y) - 1.96 * stddev_samp(y) / sqrt(count(y)), 6) AS lower,
  round(avg(y) + 1.96 * stddev_samp(y) / sqrt(count(y)), 6) AS upper FROM w GROUP BY week""")
def weekly_mean(spark, sf):
    e = table(spark, sf, "events").select(
        F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7).alias("week"),
        (F.col("event_type") == "purchase").cast("int").alias("y"))
    return rounded(A.mean_by(e, "week", "y"))


@query("quality_checks", "A17", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def quality_checks(spark, sf):
    return A.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_checks", "A17", sql="""
SELECT bool_or(l.quality IS NULL) AS has_null_quality, CAST(sum(CAST(l.quality IS NULL AS BIGINT)) AS BIGINT) AS n_null_quality,
  bool_or(d.text IS NULL) AS has_null_text, CAST(sum(CAST(d.text IS NULL AS BIGINT)) AS BIGINT) AS n_null_text
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def null_checks(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return A.null_check(d, ["quality", "text"])


# ---------------------------------------------------------------- group lists

@query("collect_series", "A13", sql="""
SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS l_partkey_list FROM lineitem GROUP BY l_orderkey""")
def collect_series(spark, sf):
    return A.collect_per(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey")


@query("label_vector", "A14", sql="""
SELECT l_orderkey, list(q ORDER BY l_linenumber, l_returnflag, q) AS labels
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, CAST(l_quantity AS INTEGER) AS q FROM lineitem)
GROUP BY l_orderkey""")
def label_vector_q(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("q", F.col("l_quantity").cast("int"))
    return A.label_vector(li, "l_orderkey", ["l_linenumber", "l_returnflag"], "q")


@query("constant_check", "A16", sql="""
SELECT l_orderkey, count(DISTINCT l_linestatus) AS n_l_linestatus, count(DISTINCT l_returnflag) AS n_l_returnflag
FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linestatus) > 1 OR count(DISTINCT l_returnflag) > 1""")
def constant_check(spark, sf):
    return A.assert_constant(table(spark, sf, "lineitem"), "l_orderkey", ["l_linestatus", "l_returnflag"])


@query("group_first", "A15 O1", sql="""
SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders ORDER BY o_orderpriority, o_orderstatus""")
def group_first(spark, sf):
    return (table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus").distinct()
            .orderBy("o_orderpriority", "o_orderstatus"))


@query("split_stacks", "A22", sql="""
SELECT e.event_id, e.user_id, e.event_type, s.stack FROM events e JOIN
 (SELECT user_id, event_type, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) - 1 AS INTEGER) AS stack
  FROM (SELECT DISTINCT user_id, event_type FROM events)) s USING (user_id, event_type)""")
def split_stacks_q(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return A.split_stacks(e, "user_id", "event_type")


# ---------------------------------------------------------------- per-group scaling

@query("clip_scale", "A18 F21", sql="""
WITH q AS (SELECT event_type, quantile_cont(value, 0.001) AS lo, quantile_cont(value, 0.999) AS hi FROM events
           GROUP BY event_type)
SELECT e.event_id, e.event_type, e.value, CASE WHEN q.hi > q.lo THEN
  CAST(trunc((least(greatest(e.value, q.lo), q.hi) - q.lo) / (q.hi - q.lo) * 255) AS INTEGER) ELSE 0 END AS scaled
FROM events e JOIN q USING (event_type)""")
def clip_scale_q(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    return A.clip_scale(e, "value", "event_type")


@query("minmax_scale", "A19", sql="""
WITH m AS (SELECT user_id, min(value) AS mn, max(value) AS mx FROM events GROUP BY user_id)
SELECT e.user_id, e.event_id, e.value, round((e.value - m.mn) / (m.mx - m.mn + 1e-6) * 255, 6) AS scaled
FROM events e JOIN m USING (user_id)""")
def minmax_scale_q(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "value")
    return rounded(A.minmax_scale(e, "value", "user_id"))


# ---------------------------------------------------------------- completeness

@query("complete_groups", "A21 W1 P16", sql="""
WITH d AS (SELECT DISTINCT user_id, event_type, CAST(isodow(ts) AS INTEGER) % 2 AS odd FROM events WHERE value IS NOT NULL),
s AS (SELECT user_id, event_type, count(*) AS n FROM d GROUP BY user_id, event_type),
k AS (SELECT user_id FROM s GROUP BY user_id HAVING bool_and(n = 2) AND sum(n) = 2 * (SELECT count(DISTINCT event_type) FROM events))
SELECT d.* FROM d WHERE user_id IN (SELECT user_id FROM k)""")
def complete_groups_q(spark, sf):
    e = table(spark, sf, "events").dropna(subset=["value"])
    d = e.select("user_id", "event_type", ((F.weekday(F.col("ts").cast("date")) + 1) % 2).alias("odd")).distinct()
    types = table(spark, sf, "events").agg(F.count_distinct("event_type")).first()[0]
    return A.complete_groups(d, "user_id", "event_type", {}, total=2 * types, default=2)


@query("group_size", "W1", sql="""
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS group_size FROM events""")
def group_size(spark, sf):
    return W.with_group_size(table(spark, sf, "events").select("event_id", "user_id"), "user_id")


# ---------------------------------------------------------------- positions

_USER_RANK = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1"


@query("sample_evenly", "W2", sql=f"""
WITH r AS (SELECT user_id, event_id, {_USER_RANK} AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events),
s AS (SELECT DISTINCT user_id, n FROM r), j AS (SELECT * FROM s, range(1, 11) t(j))
SELECT r.user_id, r.event_id, CAST(j.j - 1 AS INTEGER) AS slot FROM j JOIN r ON r.user_id = j.user_id
 AND r.r = greatest(0, round_even(j.j * j.n / 10.0 - 0.5001, 0))""")
def sample_evenly_q(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return W.sample_evenly(e, "user_id", ["ts", "event_id"], k=10).select("user_id", "event_id", "slot")


@query("thin", "W4", sql=f"""
WITH r AS (SELECT user_id, event_id, {_USER_RANK} AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, event_id FROM r WHERE r % greatest(3, ceil(n / 6e6)) = 0""")
def thin_q(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return W.thin(e, "user_id", ["ts", "event_id"], factor=3).select("user_id", "event_id")


@query("folds", "W6", sql="""
SELECT user_id, event_id, CAST(ntile(5) OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS fold
FROM events""")
def folds(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return W.split_folds(e, 5, ["ts", "event_id"], by="user_id").select("user_id", "event_id", "fold")


@query("natural_sort", "O3 W3", sql=r"""
WITH s AS (SELECT s_suppkey, regexp_replace(s_name, '#0*([0-9])', '#\1') AS name FROM supplier)
SELECT s_suppkey, name, row_number() OVER (ORDER BY list_transform(regexp_extract_all(name, '\d+|\D+'),
  lambda x: CASE WHEN regexp_full_match(x, '\d+') THEN lpad(x, 20, '0') ELSE x END), s_suppkey) - 1 AS rank FROM s""")
def natural_sort(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.regexp_replace("s_name", r"#0*([0-9])", r"#$1").alias("name"))
    return W.rank_within(s, None, [W.natural_sort_key("name"), F.col("s_suppkey")], alias="rank")


@query("length_batches", "O5", sql="""
SELECT doc_id, row_number() OVER (ORDER BY length(text) DESC, doc_id) - 1 AS length_rank,
  CAST(floor((row_number() OVER (ORDER BY length(text) DESC, doc_id) - 1) / 16) AS INTEGER) AS batch FROM documents""")
def length_batches(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return W.with_length_batches(d, "text", "doc_id", 16).select("doc_id", "length_rank", "batch")


# ---------------------------------------------------------------- small operators on their own


@query("drop_null_rows", "P16", sql="""
SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def drop_null_rows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", "lang", "quality", "toxic").dropna()


@query("map_per", "A13", sql="""
SELECT n_regionkey, string_agg(n_name || '=' || CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_name) AS mapping
FROM nation GROUP BY n_regionkey""")
def map_per_q(spark, sf):
    m = A.map_per(table(spark, sf, "nation"), "n_regionkey", "n_name", "n_nationkey")
    pairs = F.array_sort(F.map_entries("mapping"))
    return m.select("n_regionkey", F.array_join(F.transform(pairs, lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("mapping"))


@query("map_per_order", "A13", sql="""
SELECT l_orderkey, string_agg(l_linenumber || '=' || n, ',' ORDER BY l_linenumber) AS mapping
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
GROUP BY l_orderkey""")
def map_per_order_q(spark, sf):
    li = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.map_entries("mapping"))
    return A.map_per(li, "l_orderkey", "l_linenumber", "n").select("l_orderkey", F.array_join(F.transform(
        pairs, lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"].cast("string"))), ",").alias("mapping"))


@query("nonzero_cells", "U9", sql="""
WITH a AS (SELECT l_orderkey, l_linenumber, [l_partkey % 3, l_suppkey % 2, l_linenumber % 2] AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(i AS INTEGER) AS pos, CAST(v[i + 1] AS BIGINT) AS v
FROM a, range(0, 3) r(i) WHERE v[i + 1] <> 0""")
def nonzero_cells_q(spark, sf):
    from ..operators import reshape as R
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.array(
        (F.col("l_partkey") % 3).cast("bigint"), (F.col("l_suppkey") % 2).cast("bigint"),
        (F.col("l_linenumber") % 2).cast("bigint")).alias("cells"))
    return R.nonzero_cells(li, "cells")


@query("l2_normalize", "F15", sql="""
SELECT vec_id, round(sum(x * x) / sum(x * x), 6) AS norm, round(max(CASE WHEN i = 1 THEN x END) / sqrt(sum(x * x)), 5) AS head
FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
GROUP BY vec_id""")
def l2_normalize_q(spark, sf):
    from ..operators import retrieval as R
    e = table(spark, sf, "embeddings").select("vec_id", R.l2_normalize("embedding").alias("u"))
    return e.select("vec_id", F.round(R.dot("u", "u"), 6).alias("norm"), F.round(F.get("u", F.lit(0)), 5).alias("head"))


@query("mean_blend", "M9", sql="""
SELECT c_custkey, round((CAST(c_acctbal AS DOUBLE) + c_nationkey + c_custkey % 100) / 3, 6) AS score FROM customer""")
def mean_blend_q(spark, sf):
    from ..operators import metrics as M
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("a"),
                                            F.col("c_nationkey").cast("double").alias("b"),
                                            (F.col("c_custkey") % 100).cast("double").alias("c"))
    return M.mean_blend(c, ["a", "b", "c"]).select("c_custkey", F.round("score", 6).alias("score"))


@query("downcast", "P5", sql="""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_partkey AS BIGINT) AS l_partkey FROM lineitem""")
def downcast_q(spark, sf):
    """The values survive the narrowing (the narrowed types are in ``downcast_report``)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    kinds = dict(li.dtypes)
    small = S.downcast(li)
    return small.select(F.col("l_orderkey").cast(kinds["l_orderkey"]), F.col("l_linenumber").cast(kinds["l_linenumber"]),
                        F.col("l_quantity").cast("double"), F.col("l_partkey").cast("bigint"))
