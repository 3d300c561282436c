"""Text, key and reshape queries (F1-F13, F23, U1-U12) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregate as A
from ..operators import columns as C
from ..operators import reshape as R
from .catalog import query, table

W = r"[\p{L}\p{N}_]"


# ---------------------------------------------------------------- F1 F2 F11 F13 F23

@query("concat_null", "F1", sql="""
SELECT d.doc_id, d.lang || ' ' || d.source || ' ' || CAST(l.quality AS VARCHAR) AS joined
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def concat_null(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", X.concat_sep(["lang", "source", "quality"], " ").alias("joined"))


@query("extract", "F2", sql=r"""
SELECT page_id, nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS lang,
  nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS page, nullif(regexp_extract(url, '#(\w+)$', 1), '') AS anchor
FROM pages""")
def extract_q(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.extract("url", r"/([a-z]{2})/").alias("lang"),
                    X.extract("url", r"page=(\d+)").alias("page"), X.extract("url", r"#(\w+)$").alias("anchor"))


@query("build_keys", "F11", sql="""
SELECT doc_id, CAST(doc_id AS VARCHAR) || '_' || lang AS doc_key, split_part(CAST(doc_id AS VARCHAR) || '_' || lang, '_', 1) AS key_head,
  CAST(doc_id AS VARCHAR) || '_' || replace(lower('Source ' || source), ' ', '_') || '_' || replace(lower(lang || '/x'), '/', '_') AS row_id
FROM documents""")
def build_keys(spark, sf):
    d = table(spark, sf, "documents")
    key = X.key_join(F.col("doc_id"), F.col("lang"))
    return d.select("doc_id", key.alias("doc_key"), X.key_part(key, 0).alias("key_head"),
                    X.row_id(F.col("doc_id"), F.concat(F.lit("Source "), F.col("source")),
                             F.concat(F.col("lang"), F.lit("/x"))).alias("row_id"))


@query("paths", "F11 F13 F23", sql="""
WITH p AS (SELECT page_id, '/data/train_images/' || CAST(page_id AS VARCHAR) || '/' || CAST(length(url) AS VARCHAR) || '/'
  || CAST(page_id % 7 AS VARCHAR) || '.dcm' AS path FROM pages)
SELECT page_id, path, TRY_CAST(regexp_extract(path, '([^/]+?)(\\.[^./]*)?$', 1) AS BIGINT) AS instance,
  string_split(path, '/')[-2] AS series, string_split(path, '/')[-3] AS study,
  printf('%03d', CAST(page_id % 1000 AS INTEGER)) AS padded FROM p""")
def paths(spark, sf):
    p = table(spark, sf, "pages").select("page_id", X.image_path("/data", F.col("page_id"), F.length("url"),
                                                                  F.col("page_id") % 7).alias("path"))
    return p.select("page_id", "path", X.path_stem_id("path").alias("instance"), X.path_part("path", 2).alias("series"),
                    X.path_part("path", 3).alias("study"), X.zero_pad((F.col("page_id") % 1000).cast("int")).alias("padded"))


# ---------------------------------------------------------------- F3 F4 F5 (whole texts)

# the three profiles written out, apart from the library's own rules
CLEAN_QUERY = r"""trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(lower({0}),
  '@[\p{{L}}\p{{N}}_]+', '', 'g'), 'http[\p{{L}}\p{{N}}_]+', '', 'g'), '\(', ' '), '\)', ' '), ' +', ' ', 'g'), '[.]+', '.', 'g'), ',+', ',', 'g'), {1})"""
CLEAN_PROMPT = r"""trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace({0},
  'http[\p{{L}}\p{{N}}_]+', '', 'g'), '[.]+', '.', 'g'), ',+', ',', 'g'), '\(', ' '), '\)', ' '), ' +', ' ', 'g'), {1})"""
CLEAN_SECOND = r"""trim(regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(lower({0}),
  '@[\p{{L}}\p{{N}}_]+', '', 'g'), 'http[\p{{L}}\p{{N}}_]+', '', 'g'), '\(', ' '), '\)', ' '), ' +', ' ', 'g'), '[.]+', '.', 'g'), {1})"""
BLANKS = " || ".join(f"chr({c})" for c in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))


@query("clean_query", "F3 X2 X3", sql=f"SELECT doc_id, {CLEAN_QUERY.format('text', BLANKS)} AS cleaned FROM documents")
def clean_query(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_query("text").alias("cleaned"))


@query("clean_prompt", "F4", sql=f"SELECT doc_id, {CLEAN_PROMPT.format('text', BLANKS)} AS cleaned FROM documents")
def clean_prompt(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_prompt("text").alias("cleaned"))


@query("clean_second", "F5", sql=f"SELECT doc_id, {CLEAN_SECOND.format('text', BLANKS)} AS cleaned FROM documents")
def clean_second(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_second("text").alias("cleaned"))


# ---------------------------------------------------------------- F6 F7 F8 F9 F10

@query("tag_spans", "F6", sql=r"""
SELECT page_id, regexp_replace(array_to_string(regexp_extract_all(html, '<p>([^\n]*?)</p>', 1), ','), '^\s+|\s+$', '', 'g')
  AS spans FROM pages""")
def tag_spans(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.tag_spans("html", "p").alias("spans"))


_TRANSCRIPT = "'<|im_start|>' || role || '\n' || text || '<|im_end|>\n'"


def _transcripts(spark, sf):
    c = table(spark, sf, "conversations")
    piece = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    return c.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))), lambda s: s["p"]),
                     "").alias("transcript"))


@query("split_chain", "F7", sql=rf"""
WITH t AS (SELECT conv_id, string_agg({_TRANSCRIPT}, '' ORDER BY turn) AS transcript FROM conversations
           GROUP BY conv_id),
a AS (SELECT conv_id, regexp_replace(split_part(split_part(transcript, '<|im_start|>user', 2), '<|im_end|>', 1),
        '^\n+|\n+$', '', 'g') AS x, contains(transcript, '<|im_start|>user') AS has FROM t)
SELECT conv_id, CASE WHEN has THEN regexp_replace(string_split(x, '. ')[-1], '^\s+|\s+$', '', 'g') END AS extracted FROM a""")
def split_chain_q(spark, sf):
    t = _transcripts(spark, sf)
    return t.select("conv_id", X.split_chain("transcript", "<|im_start|>user", "<|im_end|>", ". ").alias("extracted"))


PROMPT = "[{topic}, {source}] A reader writes:\n{question}\n\nReply in {lang}."


@query("prompt", "F8", sql="""
SELECT doc_id, '[' || source || ', ' || lang || '] A reader writes:' || chr(10)
  || regexp_replace(text, '^\\s+|\\s+$', '', 'g') || chr(10) || chr(10) || 'Reply in ' || lang || '.' AS prompt FROM documents""")
def prompt(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.fill_template(PROMPT, topic=F.col("source"), source=F.col("lang"),
                                              question=X.strip("text"), lang=F.col("lang")).alias("prompt"))


@query("numbered_list", "F9", sql="""
WITH x AS (SELECT l.l_orderkey, p.p_name, row_number() OVER (PARTITION BY l.l_orderkey
             ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice) AS i
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
SELECT l_orderkey, string_agg(CAST(i AS VARCHAR) || '. ' || p_name || chr(10), '' ORDER BY i) AS retrieval FROM x
GROUP BY l_orderkey""")
def numbered_list(spark, sf):
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    x = li.join(p, "l_partkey")
    srt = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "p_name")
    names = x.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(srt)), lambda s: s["p_name"]).alias("n"))
    return names.select("l_orderkey", X.numbered_list("n").alias("retrieval"))


def _replies(spark, sf):
    c = table(spark, sf, "conversations")
    items = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))),
                                                 lambda s: s["text"]).alias("items"))
    reply = (F.when(F.col("turn") % 4 == 0, F.col("text"))
             .when(F.col("turn") % 4 == 1, F.concat(F.lit(" "), F.col("turn").cast("string"), F.lit("\n")))
             .when(F.col("turn") % 4 == 2, F.concat(F.col("turn").cast("string"), F.lit(". "), F.col("text")))
             .otherwise(F.lit("...")))
    return c.filter(F.col("role") == "assistant").select("conv_id", "turn", reply.alias("reply")).join(items, "conv_id")


@query("normalise_reply", "F10 J9", sql=rf"""
WITH items AS (SELECT conv_id, list(text ORDER BY turn) AS items FROM conversations GROUP BY conv_id),
r AS (SELECT c.conv_id, c.turn, CASE WHEN c.turn % 4 = 0 THEN c.text WHEN c.turn % 4 = 1 THEN ' ' || CAST(c.turn AS VARCHAR) || chr(10)
  WHEN c.turn % 4 = 2 THEN CAST(c.turn AS VARCHAR) || '. ' || c.text ELSE '...' END AS reply, i.items
  FROM conversations c JOIN items i USING (conv_id) WHERE c.role = 'assistant'),
t AS (SELECT *, regexp_replace(reply, '^\s+|\s+$', '', 'g') AS txt FROM r),
k AS (SELECT *, regexp_extract(txt, '^{W}+\.?', 0) AS token FROM t)
SELECT conv_id, turn, CASE WHEN length(token) > 0 AND contains(token, '.')
    THEN regexp_replace(replace(txt, token, ''), '^\s+|\s+$', '', 'g')
  WHEN length(token) = length(txt) THEN CASE WHEN TRY_CAST(token AS INTEGER) BETWEEN 1 AND len(items)
    THEN items[TRY_CAST(token AS INTEGER)] ELSE items[1] END
  ELSE txt END AS normalised FROM k""")
def normalise_reply_q(spark, sf):
    r = _replies(spark, sf)
    return r.select("conv_id", "turn", X.normalise_reply("reply", "items").alias("normalised"))


@query("ids_round_trip", "F12", sql="""
WITH s AS (SELECT l_orderkey, array_to_string(list(DISTINCT l_partkey ORDER BY l_partkey), ' ') AS ids FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, ids, CAST(len(list_transform(string_split(ids, ' '), lambda x: CAST(x AS BIGINT))) AS INTEGER) AS n_ids,
  list_transform(string_split(ids, ' '), lambda x: CAST(x AS BIGINT))[1] AS first_id FROM s""")
def ids_round_trip(spark, sf):
    s = A.collect_per(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey", alias="arr")
    s = s.select("l_orderkey", X.array_to_ids("arr").alias("ids"))
    back = X.ids_to_array("ids")
    return s.select("l_orderkey", "ids", F.size(back).alias("n_ids"), F.element_at(back, 1).alias("first_id"))


# ---------------------------------------------------------------- U1 U2 U3 U4 U5

@query("unpivot", "U1 T1", sql=r"""
SELECT p_partkey, variable, value, nullif(regexp_extract(variable, '^p_(\w+)$', 1), '') AS measure FROM
 (UNPIVOT (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice,
           CASE WHEN p_size > 25 THEN CAST(p_size AS DOUBLE) END AS p_big FROM part)
  ON p_size, p_retailprice, p_big INTO NAME variable VALUE value)
UNION ALL SELECT p_partkey, 'p_big', NULL, 'big' FROM part WHERE NOT p_size > 25""")
def unpivot_q(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice",
                                        F.when(F.col("p_size") > 25, F.col("p_size")).alias("p_big"))
    return R.unpivot_parsed(p, ["p_partkey"], ["p_size", "p_retailprice", "p_big"], r"^p_(\w+)$", "variable", "value",
                            parsed="measure", value_type="double")


_SEVERITY_WIDE = """SELECT c_custkey AS study_id,
  CASE WHEN c_acctbal < 3000 THEN 'Normal/Mild' WHEN c_acctbal < 7000 THEN 'Moderate' ELSE 'Severe' END AS spinal_canal_stenosis_l1_l2,
  CASE c_nationkey % 3 WHEN 0 THEN 'Normal/Mild' WHEN 1 THEN 'Moderate' END AS left_subarticular_stenosis_l4_l5,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'Severe' ELSE 'Normal/Mild' END AS right_neural_foraminal_narrowing_l5_s1
FROM customer"""


def _severity_wide(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("study_id"),
        F.when(F.col("c_acctbal") < 3000, "Normal/Mild").when(F.col("c_acctbal") < 7000, "Moderate")
        .otherwise("Severe").alias("spinal_canal_stenosis_l1_l2"),
        F.when(F.col("c_nationkey") % 3 == 0, "Normal/Mild").when(F.col("c_nationkey") % 3 == 1, "Moderate")
        .alias("left_subarticular_stenosis_l4_l5"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Severe").otherwise("Normal/Mild")
        .alias("right_neural_foraminal_narrowing_l5_s1"))


# Severity labels and their codes.
SEVERITY = {"Normal/Mild": 0, "Moderate": 1, "Severe": 2}


@query("unpivot_levels", "U2 P18 F11", sql=f"""
WITH w AS ({_SEVERITY_WIDE}),
l AS (SELECT * FROM w UNPIVOT INCLUDE NULLS (severity FOR var IN (spinal_canal_stenosis_l1_l2,
           left_subarticular_stenosis_l4_l5, right_neural_foraminal_narrowing_l5_s1))),
p AS (SELECT study_id, string_split(var, '_') AS parts, severity FROM l),
c AS (SELECT study_id, array_to_string(list_transform(parts[1:len(parts) - 2], lambda w: upper(w[1]) || lower(w[2:])), ' ')
      AS condition, upper(parts[-2][1]) || lower(parts[-2][2:]) || '/' || upper(parts[-1][1]) || lower(parts[-1][2:]) AS level,
      severity FROM p)
SELECT study_id, condition, level, CASE severity WHEN 'Normal/Mild' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Severe' THEN 2
  ELSE -100 END AS severity,
  CAST(study_id AS VARCHAR) || '_' || replace(lower(condition), ' ', '_') || '_' || replace(lower(level), '/', '_') AS row_id
FROM c""")
def unpivot_levels(spark, sf):
    long = R.unpivot_levels(_severity_wide(spark, sf), ["study_id"])
    long = C.fill_sentinel(C.map_values(long, ["severity"], SEVERITY, on_missing="error", out_type="int"), -100,
                           ["severity"])
    return long.withColumn("row_id", X.row_id(F.col("study_id"), F.col("condition"), F.col("level")))


@query("columns_to_array", "U10", sql=f"""
SELECT study_id, [CASE spinal_canal_stenosis_l1_l2 WHEN 'Normal/Mild' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Severe' THEN 2 ELSE -100 END,
  CASE left_subarticular_stenosis_l4_l5 WHEN 'Normal/Mild' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Severe' THEN 2 ELSE -100 END,
  CASE right_neural_foraminal_narrowing_l5_s1 WHEN 'Normal/Mild' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Severe' THEN 2 ELSE -100 END]
  AS labels FROM ({_SEVERITY_WIDE})""")
def columns_to_array(spark, sf):
    w = _severity_wide(spark, sf)
    cols = [c for c in w.columns if c != "study_id"]
    w = C.fill_sentinel(C.map_values(w, cols, SEVERITY, out_type="int"), -100, cols)
    return w.select("study_id", R.columns_to_array(cols).alias("labels"))


@query("explode_list", "U3 U4", sql="""
WITH s AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS ids FROM lineitem
           GROUP BY l_orderkey)
SELECT l_orderkey, CAST(u.pos AS INTEGER) AS pos, u.part FROM s,
  LATERAL (SELECT generate_subscripts(s.ids, 1) - 1 AS pos, unnest(s.ids) AS part) u""")
def explode_list(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "o", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    lists = R.attach_list(li, "l_orderkey", "l_partkey", "o", alias="ids", as_string=False)
    return lists.select("l_orderkey", F.posexplode("ids").alias("pos", "part"))


@query("attach_list", "U4 F12", sql="""
SELECT l_orderkey, array_to_string(list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity), ' ')
  AS ranked FROM lineitem GROUP BY l_orderkey""")
def attach_list(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "o", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    return R.attach_list(li, "l_orderkey", "l_partkey", "o", alias="ranked")


_OPTIONS_SQL = """SELECT o_orderkey AS QuestionId, chr(CAST(65 + o_orderkey % 4 AS INTEGER)) AS CorrectAnswer,
  o_orderpriority AS ConstructName, o_orderstatus AS SubjectName, o_orderpriority AS AnswerAText, o_orderstatus AS AnswerBText,
  CAST(o_custkey AS VARCHAR) AS AnswerCText, CASE WHEN o_totalprice > 100000 THEN CAST(o_orderkey AS VARCHAR) END AS AnswerDText,
  CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS MisconceptionAId, CASE WHEN o_custkey % 3 = 0 THEN o_custkey END AS MisconceptionBId,
  o_custkey AS MisconceptionCId, CASE WHEN o_custkey % 5 = 0 THEN o_custkey END AS MisconceptionDId FROM orders"""


def _options(spark, sf):
    o = table(spark, sf, "orders")
    ck = F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").alias("QuestionId"),
        F.expr("chr(cast(65 + o_orderkey % 4 as int))").alias("CorrectAnswer"),
        F.col("o_orderpriority").alias("ConstructName"), F.col("o_orderstatus").alias("SubjectName"),
        F.col("o_orderpriority").alias("AnswerAText"), F.col("o_orderstatus").alias("AnswerBText"),
        ck.cast("string").alias("AnswerCText"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_orderkey").cast("string")).alias("AnswerDText"),
        F.when(ck % 2 == 0, ck).alias("MisconceptionAId"), F.when(ck % 3 == 0, ck).alias("MisconceptionBId"),
        ck.alias("MisconceptionCId"), F.when(ck % 5 == 0, ck).alias("MisconceptionDId"))


@query("expand_options", "U5 F1 F11", sql=f"""
WITH q AS ({_OPTIONS_SQL}),
x AS (SELECT q.*, o.* FROM q, (VALUES ('A'), ('B'), ('C'), ('D')) o(option))
SELECT CAST(QuestionId AS VARCHAR) || '_' || option AS QuestionId_Answer, QuestionId, option,
  CASE option WHEN 'A' THEN AnswerAText WHEN 'B' THEN AnswerBText WHEN 'C' THEN AnswerCText ELSE AnswerDText END AS option_text,
  CASE option WHEN 'A' THEN MisconceptionAId WHEN 'B' THEN MisconceptionBId WHEN 'C' THEN MisconceptionCId ELSE MisconceptionDId END AS label,
  ConstructName || ' ' || SubjectName || ' ' || CASE option WHEN 'A' THEN AnswerAText WHEN 'B' THEN AnswerBText
    WHEN 'C' THEN AnswerCText ELSE AnswerDText END AS AllText
FROM x WHERE option <> CorrectAnswer AND (CASE option WHEN 'A' THEN MisconceptionAId WHEN 'B' THEN MisconceptionBId
  WHEN 'C' THEN MisconceptionCId ELSE MisconceptionDId END) IS NOT NULL""")
def expand_options(spark, sf):
    opts = {k: f"Answer{k}Text" for k in "ABCD"}
    labels = {k: f"Misconception{k}Id" for k in "ABCD"}
    return R.expand_options(_options(spark, sf), "QuestionId", "CorrectAnswer", opts, labels,
                            text_parts=["ConstructName", "SubjectName"], require_label=True)


# ---------------------------------------------------------------- U8 U11 U12 (label vectors from events)

# Slot offsets per event type (five blocks of five weeks).
EVENT_OFFSETS = {"click": 0, "error": 5, "purchase": 10, "signup": 15, "view": 20}
_WEEK = "CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER)"
_SLOTS_SQL = f"""
cnt AS (SELECT user_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 5 WHEN 'purchase' THEN 10
          WHEN 'signup' THEN 15 ELSE 20 END + {_WEEK} AS slot, count(*) AS n FROM events GROUP BY ALL),
frame AS (SELECT u.user_id, s.slot FROM (SELECT DISTINCT user_id FROM events) u, range(0, 25) s(slot)),
slots AS (SELECT f.user_id, CAST(f.slot AS INTEGER) AS slot, coalesce(c.n, 0) AS n FROM frame f
          LEFT JOIN cnt c ON c.user_id = f.user_id AND c.slot = f.slot)"""


def _slots(spark, sf):
    e = table(spark, sf, "events")
    wk = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7).cast("int")
    cnt = e.groupBy("user_id", "event_type", wk.alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return R.slot_layout(cnt, "user_id", "event_type", "week", EVENT_OFFSETS, 25, "n", empty=0)


@query("slot_layout", "U12", sql=f"WITH {_SLOTS_SQL} SELECT user_id, slot, n FROM slots")
def slot_layout(spark, sf):
    return _slots(spark, sf)


def _vectors(spark, sf):
    s = _slots(spark, sf)
    return s.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "n"))),
                                                lambda x: x["n"]).alias("labels"))


@query("mirror", "U8 F20", sql=f"""
WITH {_SLOTS_SQL}, v AS (SELECT user_id, list(n ORDER BY slot) AS labels FROM slots GROUP BY user_id)
SELECT user_id, labels, false AS mirrored FROM v
UNION ALL SELECT user_id, labels[11:20] || labels[1:10] || labels[21:25], true FROM v""")
def mirror(spark, sf):
    return R.mirror(_vectors(spark, sf), "labels", block=10)


@query("chunk_array", "U11", sql=f"""
WITH {_SLOTS_SQL}, v AS (SELECT user_id, list(n ORDER BY slot) AS labels FROM slots GROUP BY user_id)
SELECT user_id, CAST(i AS INTEGER) AS chunk, labels[i * 5 + 1 : i * 5 + 5] AS cells FROM v, range(0, 5) r(i)""")
def chunk_array(spark, sf):
    v = _vectors(spark, sf)
    return v.select("user_id", F.posexplode(R.chunk_array("labels", 5)).alias("chunk", "cells"))
