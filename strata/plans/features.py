"""Relational feature-table queries (entry point A of the survey) on the driver tables.

Stand-ins: base = ``orders`` (key ``o_orderkey`` -> ``case_id``, decision date
``o_orderdate``), depth-1 child = ``lineitem`` with ordinal ``l_linenumber``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregate as A
from ..operators import columns as C
from ..operators import encode as E
from ..operators import joins as J
from ..operators import schema as S
from ..session import materialised
from .catalog import query, rounded, table
from .sqlgen import suffix_agg_sql

# ---- stand-in views ---------------------------------------------------------------

CHILD_ORDER = ["num_group1", "l_partkey", "l_suppkey", "quantity_P", "price_A", "discount_A",
               "ship_D", "flag_M", "status_L"]


def child_view(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as a depth-1 child table named by the suffix convention."""
    li = table(spark, sf, "lineitem")
    return S.apply_type_rules(li.select(
        F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("num_group1"),
        "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("quantity_P"), F.col("l_extendedprice").alias("price_A"),
        F.col("l_discount").alias("discount_A"), F.col("l_shipdate").alias("ship_D"),
        F.col("l_returnflag").alias("flag_M"), F.col("l_linestatus").alias("status_L")))


def base_view(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    return S.apply_type_rules(o.select(
        F.col("o_orderkey").alias("case_id"), d.alias("date_decision"),
        (F.year(d) * 100 + F.month(d)).alias("MONTH"),
        F.floor(F.datediff(d, F.lit("1992-01-01").cast("date")) / 7).alias("WEEK_NUM"),
        (F.col("o_orderstatus") == "F").cast("int").alias("target"),
        F.col("o_totalprice").alias("totalprice_A"), F.col("o_orderpriority").alias("priority_M")))


CHILD_SQL = ("SELECT l_orderkey AS case_id, CAST(l_linenumber AS BIGINT) AS num_group1, l_partkey, l_suppkey, "
             "l_quantity AS quantity_P, l_extendedprice AS price_A, l_discount AS discount_A, "
             "CAST(l_shipdate AS DATE) AS ship_D, l_returnflag AS flag_M, l_linestatus AS status_L FROM lineitem")
BASE_SQL = ("SELECT o_orderkey AS case_id, CAST(o_orderdate AS DATE) AS date_decision, "
            "year(o_orderdate) * 100 + month(o_orderdate) AS MONTH, "
            "CAST(floor(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 7) AS BIGINT) AS WEEK_NUM, "
            "CAST(o_orderstatus = 'F' AS INTEGER) AS target, o_totalprice AS totalprice_A, "
            "o_orderpriority AS priority_M FROM orders")
CHILD_COLS = [("quantity_P", "num"), ("price_A", "num"), ("discount_A", "num"), ("ship_D", "date"),
              ("flag_M", "str"), ("status_L", "other"), ("num_group1", "group")]


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """Typed base + aggregated child -> wide feature table."""
    child = A.aggregate(child_view(spark, sf), "case_id", A.AggSpec(), order_by=CHILD_ORDER)
    wide = J.join_all(base_view(spark, sf), [child], on="case_id")
    wide = C.add_calendar(wide, "date_decision", at=5)
    return C.dates_to_offsets(wide, "date_decision")


def _feature_table_sql() -> str:
    agg = suffix_agg_sql(CHILD_SQL, "case_id", CHILD_COLS, CHILD_ORDER)
    names = []
    for fam_aggs, fam in ((("max", "min", "first", "last", "mean"), ("quantity_P", "price_A", "discount_A")),
                          (("max", "min", "first", "last", "mean"), ("ship_D",)),
                          (("max", "min", "first", "last"), ("flag_M",)), (("mode",), ("flag_M",)),
                          (("max", "min", "first", "last"), ("status_L",)),
                          (("max", "min", "first", "last"), ("num_group1",))):
        for a in fam_aggs:
            for c in fam:
                n = f"{a}_{c}"
                if c == "ship_D" and a == "mean":
                    names.append(f"CAST(trunc(c.{n} - date_diff('day', DATE '1970-01-01', b.date_decision)) AS INTEGER) AS {n}")
                elif c == "ship_D":
                    names.append(f"CAST(date_diff('day', b.date_decision, c.{n}) AS INTEGER) AS {n}")
                elif a == "mean":
                    names.append(f"round(c.{n}, 6) AS {n}")
                else:
                    names.append(f"c.{n}")
    return (f"SELECT b.case_id, b.WEEK_NUM, b.target, b.totalprice_A, b.priority_M, "
            f"CAST(month(b.date_decision) AS INTEGER) AS month_decision, "
            f"CAST(isodow(b.date_decision) AS INTEGER) AS weekday_decision, {', '.join(names)} "
            f"FROM ({BASE_SQL}) b LEFT JOIN {agg} c USING (case_id)")


query("feature_table", "S1 P1 A2 A3 A4 A5 J1 P4 P2 X1", _feature_table_sql())(
    lambda spark, sf: rounded(feature_table(spark, sf)))


@query("agg_max_min", "A1", sql=f"""
SELECT case_id,
  max(quantity_P) AS max_quantity_P, max(price_A) AS max_price_A, max(discount_A) AS max_discount_A,
  max(ship_D) AS max_ship_D, max(flag_M) AS max_flag_M, max(status_L) AS max_status_L,
  max(num_group1) AS max_num_group1,
  min(quantity_P) AS min_quantity_P, min(price_A) AS min_price_A, min(discount_A) AS min_discount_A,
  min(ship_D) AS min_ship_D, min(flag_M) AS min_flag_M, min(status_L) AS min_status_L,
  min(num_group1) AS min_num_group1
FROM ({CHILD_SQL}) GROUP BY case_id""")
def agg_max_min(spark, sf):
    return A.agg_by_suffix(child_view(spark, sf), "case_id")


_PARTS_SQL = ("SELECT l_orderkey AS case_id, count(*) AS n_parts, max(l_tax) AS max_price_A FROM lineitem GROUP BY l_orderkey")


@query("bucketed_chain", "J1", sql=f"""
SELECT b.case_id, b.target, b.totalprice_A, c.max_price_A, c.min_price_A, c.max_ship_D, c.min_flag_M,
  p.n_parts, p.max_price_A AS max_price_A_1
FROM ({BASE_SQL}) b
LEFT JOIN (SELECT case_id, max(price_A) AS max_price_A, min(price_A) AS min_price_A, max(ship_D) AS max_ship_D,
  min(flag_M) AS min_flag_M FROM ({CHILD_SQL}) GROUP BY case_id) c USING (case_id)
LEFT JOIN ({_PARTS_SQL}) p USING (case_id)""")
def bucketed_chain(spark, sf):
    """Base and two child aggregates written once by case_id, then chained without an exchange."""
    base = base_view(spark, sf).select("case_id", "target", "totalprice_A")
    child = A.agg_by_suffix(child_view(spark, sf), "case_id").select("case_id", "max_price_A", "min_price_A", "max_ship_D",
                                                                     "min_flag_M")
    parts = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("case_id")).agg(
        F.count(F.lit(1)).alias("n_parts"), F.max("l_tax").alias("max_price_A"))
    base, child, parts = (J.bucketed(t, "case_id", name=n) for t, n in ((base, "base"), (child, "child"), (parts, "parts")))
    return J.join_all(base, [child, parts], on="case_id")


@query("agg_full_spec", "A2 A3 A4 A5 X6", sql=suffix_agg_sql(CHILD_SQL, "case_id", CHILD_COLS, CHILD_ORDER,
                                                          round_mean=6)
       .replace("avg(date_diff('day', DATE '1970-01-01', ship_D))",
                "round(avg(date_diff('day', DATE '1970-01-01', ship_D)), 6)")[1:-1])
def agg_full_spec(spark, sf):
    return rounded(A.aggregate(child_view(spark, sf), "case_id", A.AggSpec(), order_by=CHILD_ORDER))


_TWO_STAGE_COLS = [(c, f) for c, f in CHILD_COLS]


def _two_stage_sql() -> str:
    src = CHILD_SQL.replace(" FROM lineitem", ", l_suppkey % 4 AS chunk FROM lineitem")
    return suffix_agg_sql(src, "case_id", _TWO_STAGE_COLS, ["chunk"] + CHILD_ORDER,
                          num=("max", "min", "first", "last"), mode=False,
                          name_fmt="{agg}_{agg}_{col}")[1:-1]


@query("agg_two_stage", "A7", sql=_two_stage_sql())
def agg_two_stage(spark, sf):
    """Chunks = ``l_suppkey % 4`` (the reference's file chunks), in one scan."""
    child = child_view(spark, sf).withColumn("chunk", F.col("l_suppkey") % 4)
    spec = A.AggSpec(num_aggs=("max", "min", "first", "last"), str_mode=False)
    return A.aggregate_two_stage(child, "case_id", "chunk", spec, order_by=CHILD_ORDER)


@query("any_match", "A6", sql="""
SELECT l_orderkey AS case_id, max(l_quantity > 31) AS quantity_over31,
       max(l_returnflag = 'R') AS any_returned, max(l_extendedprice) AS price_A_max
FROM lineitem GROUP BY l_orderkey""")
def any_match(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("case_id")).agg(
        A.any_match(F.col("l_quantity") > 31, "quantity_over31"),
        A.any_match(F.col("l_returnflag") == "R", "any_returned"),
        F.max("l_extendedprice").alias("price_A_max"))


@query("applicant_row", "P14 J1", sql="""
SELECT o.o_orderkey AS case_id, o.o_totalprice, l.l_partkey AS first_partkey, l.l_returnflag AS first_flag
FROM orders o LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber = 1) l ON o.o_orderkey = l.l_orderkey""")
def applicant_row(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("case_id"), "l_linenumber",
                                              "l_partkey", "l_returnflag")
    first = C.filter_ordinal(li, "l_linenumber", 1, {"l_partkey": "first_partkey", "l_returnflag": "first_flag"})
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("case_id"), "o_totalprice")
    return J.left_join_suffixed(base, first, "case_id", "_1")


# documents left join labels: the nullable wide table
def wide_docs(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("case_id"), F.col("lang").alias("lang_M"), F.col("source").alias("source_M"),
        F.col("n_chars").cast("double").alias("chars_A"), F.col("quality").cast("double").alias("quality_P"),
        F.col("toxic").alias("toxic_L"), F.when(F.col("text").contains("\n"), "multi").otherwise("single").alias("lines_M"),
        F.col("text").alias("text_M"), F.lit("x").alias("const_M"))


_WIDE_SQL = ("SELECT d.doc_id AS case_id, d.lang AS lang_M, d.source AS source_M, CAST(d.n_chars AS DOUBLE) AS chars_A, "
             "CAST(l.quality AS DOUBLE) AS quality_P, l.toxic AS toxic_L, CASE WHEN strpos(d.text, chr(10)) > 0 THEN 'multi' ELSE 'single' END AS lines_M, "
             "d.text AS text_M, 'x' AS const_M FROM documents d LEFT JOIN labels l USING (doc_id)")


_PRUNE_SQL = f"""
WITH w AS ({_WIDE_SQL}),
s AS (SELECT
  avg(CAST(lang_M IS NULL AS DOUBLE)) AS n_lang_M, avg(CAST(source_M IS NULL AS DOUBLE)) AS n_source_M,
  avg(CAST(chars_A IS NULL AS DOUBLE)) AS n_chars_A, avg(CAST(quality_P IS NULL AS DOUBLE)) AS n_quality_P,
  avg(CAST(toxic_L IS NULL AS DOUBLE)) AS n_toxic_L, avg(CAST(lines_M IS NULL AS DOUBLE)) AS n_lines_M,
  avg(CAST(text_M IS NULL AS DOUBLE)) AS n_text_M, avg(CAST(const_M IS NULL AS DOUBLE)) AS n_const_M,
  count(DISTINCT lang_M) + max(CAST(lang_M IS NULL AS INT)) AS u_lang_M,
  count(DISTINCT source_M) + max(CAST(source_M IS NULL AS INT)) AS u_source_M,
  count(DISTINCT lines_M) + max(CAST(lines_M IS NULL AS INT)) AS u_lines_M,
  count(DISTINCT text_M) + max(CAST(text_M IS NULL AS INT)) AS u_text_M,
  count(DISTINCT const_M) + max(CAST(const_M IS NULL AS INT)) AS u_const_M FROM w)
SELECT "column", round(null_share, 6) AS null_share,
       CASE WHEN null_share > 0.95 THEN NULL ELSE CAST(n_unique AS BIGINT) END AS n_unique,
       (null_share > 0.95) OR (n_unique IS NOT NULL AND (n_unique = 1 OR n_unique > 200)) AS dropped
FROM (SELECT 'lang_M' AS "column", n_lang_M AS null_share, u_lang_M AS n_unique FROM s
  UNION ALL SELECT 'source_M', n_source_M, u_source_M FROM s
  UNION ALL SELECT 'chars_A', n_chars_A, NULL FROM s
  UNION ALL SELECT 'quality_P', n_quality_P, NULL FROM s
  UNION ALL SELECT 'toxic_L', n_toxic_L, NULL FROM s
  UNION ALL SELECT 'lines_M', n_lines_M, u_lines_M FROM s
  UNION ALL SELECT 'text_M', n_text_M, u_text_M FROM s
  UNION ALL SELECT 'const_M', n_const_M, u_const_M FROM s)"""


@query("prune_report", "P3 A8", sql=_PRUNE_SQL)
def prune_report_q(spark, sf):
    rep = C.prune_report(wide_docs(spark, sf), keep=("case_id",))
    return rounded(rep)


_WIDE_COLS = ("lang_M", "source_M", "chars_A", "quality_P", "toxic_L", "lines_M", "text_M", "const_M")


def _long_values(cols, numeric):
    """SQL: one (case_id, column, value) row per cell of ``cols``; numbers as decimal text."""
    parts = [f"SELECT case_id, '{c}' AS \"column\", "
             + (f"CAST(CAST({c} AS DECIMAL(20, 4)) AS VARCHAR)" if c in numeric else c) + " AS value FROM w"
             for c in cols]
    return " UNION ALL ".join(parts)


@query("pruned", "P3", sql=f"""
WITH w AS ({_WIDE_SQL}), rep AS ({_PRUNE_SQL}),
lv AS ({_long_values(_WIDE_COLS, ("chars_A", "quality_P", "toxic_L"))})
SELECT lv.case_id, lv."column", lv.value FROM lv JOIN rep ON rep."column" = lv."column" WHERE NOT rep.dropped""")
def pruned(spark, sf):
    """The pruned wide table, in long form (case_id, column, value) so that the oracle can
    check both the kept columns (decided from the data) and every kept value."""
    kept = C.prune_columns(wide_docs(spark, sf), keep=("case_id",))
    cols = [c for c in kept.columns if c != "case_id"]
    num = {f.name for f in kept.schema.fields if not isinstance(f.dataType, T.StringType)}
    vals = [(F.col(c).cast("decimal(20,4)").cast("string") if c in num else F.col(c)).alias(c) for c in cols]
    return kept.select("case_id", *vals).unpivot("case_id", cols, "column", "value")


@query("downcast_report", "P5 P6", sql="""
WITH s AS (SELECT min(l_orderkey) AS a0, max(l_orderkey) AS b0, min(l_linenumber) AS a1, max(l_linenumber) AS b1,
  min(l_quantity) AS a2, max(l_quantity) AS b2, min(l_partkey) AS a3, max(l_partkey) AS b3,
  min(l_extendedprice * 1000) AS a4, max(l_extendedprice * 1000) AS b4,
  min(CAST(l_extendedprice * 100000 AS BIGINT)) AS a5, max(CAST(l_extendedprice * 100000 AS BIGINT)) AS b5 FROM lineitem),
r AS (SELECT 'l_orderkey' AS "column", 'int' AS kind, a0 AS lo, b0 AS hi FROM s
  UNION ALL SELECT 'l_linenumber', 'int', a1, b1 FROM s UNION ALL SELECT 'l_quantity', 'float', a2, b2 FROM s
  UNION ALL SELECT 'l_partkey', 'int', a3, b3 FROM s UNION ALL SELECT 'price_milli', 'float', a4, b4 FROM s
  UNION ALL SELECT 'price_micro', 'int', a5, b5 FROM s)
SELECT "column", kind, CAST(lo AS DOUBLE) AS min_value, CAST(hi AS DOUBLE) AS max_value,
  CASE WHEN kind = 'int' AND lo > -128 AND hi < 127 THEN 'tinyint'
       WHEN kind = 'int' AND lo > -32768 AND hi < 32767 THEN 'smallint'
       WHEN kind = 'int' AND lo > -2147483648 AND hi < 2147483647 THEN 'int'
       WHEN kind = 'int' AND lo > -9223372036854775808 AND hi < 9223372036854775807 THEN 'bigint'
       WHEN kind = 'float' AND lo > -3.4028234663852886e38 AND hi < 3.4028234663852886e38 THEN 'float' END AS chosen
FROM r""")
def downcast_report(spark, sf):
    li = table(spark, sf, "lineitem")
    df = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey",
                   (F.col("l_extendedprice") * 1000).alias("price_milli"),
                   (F.col("l_extendedprice") * 100000).cast("bigint").alias("price_micro"))
    return S.downcast_plan(df)


# order dates as strings with bad values mixed in (every 7th key gets a bad form)
def _date_strings(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    s = F.date_format("o_orderdate", "yyyy-MM-dd")
    bad = (F.when(F.col("o_orderkey") % 7 == 1, F.lit("nope"))
           .when(F.col("o_orderkey") % 7 == 2, F.lit("2024-13-01"))
           .when(F.col("o_orderkey") % 7 == 3, F.lit(None).cast("string"))
           .when(F.col("o_orderkey") % 7 == 4, F.lit("")).otherwise(s))
    return o.select("o_orderkey", bad.alias("mixed_D"), s.alias("clean_D"), F.col("o_orderpriority").alias("prio_M"))


_DATE_STR_SQL = ("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 1 THEN 'nope' WHEN o_orderkey % 7 = 2 THEN '2024-13-01' "
                 "WHEN o_orderkey % 7 = 3 THEN NULL WHEN o_orderkey % 7 = 4 THEN '' "
                 "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS mixed_D, strftime(o_orderdate, '%Y-%m-%d') AS clean_D, "
                 "o_orderpriority AS prio_M FROM orders")


@query("parse_dates", "P9", sql=f"""
SELECT o_orderkey, TRY_CAST(mixed_D AS DATE) AS mixed_D, CAST(clean_D AS DATE) AS clean_D, prio_M
FROM ({_DATE_STR_SQL})""")
def parse_dates_q(spark, sf):
    df = _date_strings(spark, sf)
    df = S.parse_dates(df, ["mixed_D"], strict=False)
    return S.parse_dates(df, ["clean_D"], strict=True)


@query("detect_dates", "P10", sql=f"""
WITH d AS ({_DATE_STR_SQL})
SELECT 'mixed_D' AS "column", bool_and(mixed_D IS NULL OR TRY_CAST(mixed_D AS DATE) IS NOT NULL) AS is_date FROM d
UNION ALL SELECT 'clean_D', bool_and(clean_D IS NULL OR TRY_CAST(clean_D AS DATE) IS NOT NULL) FROM d
UNION ALL SELECT 'prio_M', bool_and(prio_M IS NULL OR TRY_CAST(prio_M AS DATE) IS NOT NULL) FROM d""")
def detect_dates(spark, sf):
    return S.detect_datetime_cols(_date_strings(spark, sf), ["mixed_D", "clean_D", "prio_M"])


@query("day_parts", "F14 P2 P4", sql="""
SELECT o_orderkey AS case_id, CAST(month(o_orderdate) AS INTEGER) AS month_decision,
  CAST(isodow(o_orderdate) AS INTEGER) AS weekday_decision, o_totalprice,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-12-31') AS INTEGER) AS horizon_D
FROM orders""")
def day_parts(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("case_id"), F.col("o_orderdate").cast("date").alias("date_decision"),
        F.lit("1998-12-31").cast("date").alias("horizon_D"), "o_totalprice")
    return C.dates_to_offsets(C.add_calendar(o, "date_decision", at=1), "date_decision")


# ---- the whole build: base, two static tables, two depth-1 children, one depth-2 child ----

BUILD_SPEC = A.AggSpec(num_aggs=("max", "min"), str_aggs=("max", "min"), group_aggs=("max", "min"))
_EXTRA_SQL = ("SELECT l_orderkey AS case_id, CAST(l_linenumber AS BIGINT) AS num_group1, l_tax AS tax_A, "
              "CAST(l_shipdate AS DATE) AS sent_D, l_linestatus AS state_M FROM lineitem WHERE l_returnflag = 'R'")
_DEEP_SQL = ("SELECT l_orderkey AS case_id, CAST(l_suppkey % 3 AS BIGINT) AS num_group1, "
             "CAST(l_linenumber AS BIGINT) AS num_group2, l_quantity AS amount_A, l_returnflag AS flag_M FROM lineitem")


def _built(spark: SparkSession, sf: str) -> DataFrame:
    """Base + 2 static + 2 depth-1 + 1 depth-2 tables in one left-join chain with ``_{i}`` suffixes."""
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    static0 = o.select(F.col("o_orderkey").alias("case_id"), F.col("o_totalprice").alias("totalprice_A"),
                       F.concat(F.lit("k"), F.col("o_custkey")).alias("cust_M"))
    static1 = o.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("case_id"), F.col("c_acctbal").alias("acctbal_A"), F.col("c_mktsegment").alias("segment_M"))
    extra = S.apply_type_rules(li.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("num_group1"), F.col("l_tax").alias("tax_A"),
        F.col("l_shipdate").alias("sent_D"), F.col("l_linestatus").alias("state_M")))
    deep = S.apply_type_rules(li.select(
        F.col("l_orderkey").alias("case_id"), (F.col("l_suppkey") % 3).alias("num_group1"),
        F.col("l_linenumber").alias("num_group2"), F.col("l_quantity").alias("amount_A"),
        F.col("l_returnflag").alias("flag_M")))
    children = [A.aggregate(x, "case_id", BUILD_SPEC) for x in (child_view(spark, sf), extra, deep)]
    wide = J.join_all(base_view(spark, sf), [static0, static1, *children], on="case_id")
    return C.dates_to_offsets(C.add_calendar(wide, "date_decision", at=5), "date_decision")


def _is_train() -> "F.Column":
    return F.col("case_id") % 4 != 0


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    num = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))}
    vals = [(F.col(c).cast("decimal(20,4)") if c in num else F.col(c)).cast("string").alias(c) for c in cols]
    return df.select("case_id", *vals).unpivot("case_id", cols, "column", "value")


_AGG = {"num": ("max", "min"), "strs": ("max", "min"), "group": ("max", "min")}
_CHILDREN_SQL = [
    suffix_agg_sql(CHILD_SQL, "case_id", CHILD_COLS, ["num_group1"], **_AGG),
    suffix_agg_sql(_EXTRA_SQL, "case_id", [("num_group1", "group"), ("tax_A", "num"), ("sent_D", "date"), ("state_M", "str")],
                   ["num_group1"], **_AGG),
    suffix_agg_sql(_DEEP_SQL, "case_id", [("num_group1", "group"), ("num_group2", "group"), ("amount_A", "num"),
                                          ("flag_M", "str")], ["num_group1", "num_group2"], **_AGG)]


def _built_sql() -> tuple[str, list[str], list[str]]:
    """(SELECT of the joined build with every column as text, its names, the string columns)."""
    cols = [("WEEK_NUM", "CAST(b.WEEK_NUM AS VARCHAR)"), ("target", "CAST(b.target AS VARCHAR)")]
    dec = "CAST(CAST({} AS DECIMAL(20, 4)) AS VARCHAR)"
    cols += [("totalprice_A", dec.format("b.totalprice_A")), ("priority_M", "b.priority_M"),
             ("month_decision", "CAST(month(b.date_decision) AS VARCHAR)"),
             ("weekday_decision", "CAST(isodow(b.date_decision) AS VARCHAR)"),
             ("totalprice_A_0", dec.format("o.o_totalprice")), ("cust_M", "'k' || o.o_custkey"),
             ("acctbal_A", dec.format("k.c_acctbal")), ("segment_M", "k.c_mktsegment")]
    strings = ["priority_M", "cust_M", "segment_M"]
    fams = [[("quantity_P", "n"), ("price_A", "n"), ("discount_A", "n"), ("ship_D", "d"), ("flag_M", "m"), ("status_L", "s"),
             ("num_group1", "g")],
            [("tax_A", "n"), ("sent_D", "d"), ("state_M", "m"), ("num_group1", "g")],
            [("amount_A", "n"), ("flag_M", "m"), ("num_group1", "g"), ("num_group2", "g")]]
    taken = set()
    for i, fam in enumerate(fams):
        for c, kind in fam:
            for agg in ("max", "min", *(["mode"] if kind == "m" else [])):
                name, ref = f"{agg}_{c}", f"t{i}.{agg}_{c}"
                out = f"{name}_{i + 2}" if name in taken else name
                taken.add(name)
                expr = (dec.format(ref) if kind == "n" else f"CAST(date_diff('day', b.date_decision, {ref}) AS VARCHAR)"
                        if kind == "d" else f"CAST({ref} AS VARCHAR)")
                cols.append((out, expr))
                if kind in "ms":
                    strings.append(out)
    joins = "".join(f" LEFT JOIN {sql} t{i} ON t{i}.case_id = b.case_id" for i, sql in enumerate(_CHILDREN_SQL))
    return (f"SELECT b.case_id, {', '.join(f'{e} AS {n}' for n, e in cols)} FROM ({BASE_SQL}) b "
            f"LEFT JOIN orders o ON o.o_orderkey = b.case_id LEFT JOIN customer k ON k.c_custkey = o.o_custkey{joins}",
            [n for n, _ in cols], strings)


def _feature_build_sql(side: str) -> str:
    wide, names, strings = _built_sql()
    quoted = ", ".join(f"'{s}'" for s in strings)
    keep = "'target', 'WEEK_NUM'"
    head = f"""WITH w AS MATERIALIZED ({wide}),
l AS (SELECT case_id, "column", value FROM w UNPIVOT INCLUDE NULLS (value FOR "column" IN ({', '.join(names)}))),
s AS (SELECT "column", avg(CAST(value IS NULL AS DOUBLE)) AS share,
        count(DISTINCT value) + max(CAST(value IS NULL AS INTEGER)) AS n FROM l WHERE case_id % 4 <> 0 GROUP BY "column"),
kept AS (SELECT "column" FROM s WHERE "column" IN ({keep}) OR (share <= 0.95
           AND ("column" NOT IN ({quoted}) OR n BETWEEN 2 AND 200))),
"""
    if side == "train":
        return head + """o AS (SELECT 1) SELECT l.case_id, l."column", l.value FROM l JOIN kept USING ("column") WHERE case_id % 4 <> 0"""
    return head + f"""lev AS (SELECT DISTINCT "column", value FROM l WHERE case_id % 4 <> 0 AND "column" IN ({quoted}) AND value IS NOT NULL)
SELECT l.case_id, l."column", CASE WHEN l."column" NOT IN ({quoted}) THEN l.value WHEN l.value IS NULL THEN 'Missing'
  WHEN lev.value IS NULL THEN 'Unknown' ELSE l.value END AS value
FROM l JOIN kept USING ("column") LEFT JOIN lev ON lev."column" = l."column" AND lev.value = l.value
WHERE l.case_id % 4 = 0 AND l."column" <> 'target'"""


@query("feature_build_train", "J1 A2 A4 P2 P3 P4", sql=_feature_build_sql("train"))
def feature_build_train(spark, sf):
    """The training side of the whole build, pruned on its own rows; in long form."""
    train = C.prune_columns(materialised(_built(spark, sf).filter(_is_train()), "build"))  # null shares, levels and rows read it
    return _long(train, [c for c in train.columns if c != "case_id"])


@query("feature_build_score", "P12 P19 J1 A2 P3", sql=_feature_build_sql("score"))
def feature_build_score(spark, sf):
    """The scoring side: the columns that pruning kept on the training side (without the target), string values
    outside the training dictionary as Unknown, nulls as Missing; in long form."""
    built = materialised(_built(spark, sf), "build")  # read by the pruning, the dictionary and the scoring side
    train = C.prune_columns(built.filter(_is_train()))
    strings = [f.name for f in train.schema.fields if isinstance(f.dataType, T.StringType)]
    score = S.align_to(built.filter(~_is_train()), train.columns, drop=("target",))
    score = E.align_categories(score, E.fit_dictionary(train, strings), strings, with_codes=False)
    return _long(score, [c for c in score.columns if c != "case_id"])
