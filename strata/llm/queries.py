"""One registered query per operator, over whole tables, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import join_null_safe

from . import (chat, dartminhash, decontaminate, lexical, quality, repair, segment, sharding, simhash, suffix_dedup,
               tokens, topk, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op2_exact_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM p)
WHERE r <= 5
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.exact_top_k(v.filter(F.col("vec_id") % 50 == 0), v, k=5)


@query("op3_quality_gam")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = tokens.scratch(spark, "features")
    quality.feature_table(table(spark, sf_dir, "documents")).write.parquet(feats)
    feats = spark.read.parquet(feats)
    model = quality.fit_quality(feats, table(spark, sf_dir, "labels"), folds=3, fold=1)
    return quality.score_quality(feats, model, folds=3, fold=1)


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokens.scratch(spark, "tokens")
    manifest = tokens.write_tokens(table(spark, sf_dir, "documents"), folder,
                                   public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return tokens.read_tokens(manifest, folder)


@query("op5_minimax_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=16)


_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op7_decontaminate", f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS t
  FROM i, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS g(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, g.s, n, array_to_string(list_slice(w, g.s, g.s + n - 1), ' ') AS t
  FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS g(s)),
hit AS (SELECT doc_id, s, win.n, item_id FROM place JOIN win ON place.t = win.t AND place.n = win.n),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(generate_series(s, s + n - 1)) AS g(k) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"),
                                                            table(spark, sf_dir, "benchmark"), window=10,
                                                            item_form="digest"))


@query("op8_toxicity_gru")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), folds=5, fold=0)
    return toxicity.score_toxicity(docs, net, folds=5, fold=0)


_ESC = "replace(replace(replace({}, '%', '%25'), '<', '%3C'), '[', '%5B')"


@query("op9_chat_format", f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
         AS loss_sha256,
       CAST(sum(length({_ESC.format('role')}) + length({_ESC.format('text')})
            + {len(chat.OPEN) + len(chat.SEP) + len(chat.CLOSE)}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql("SELECT -7L AS conv_id, t AS turn, r AS role, '</s>[INST] ok [/INST]' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_chat(chat.format_chat(turns))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
                       F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


@query("op6_dart_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op1_gumbel_segmentation")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.sample_segmentations(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                                        k=2)


_TERMS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op11_presence_masks", f"""
WITH d AS (SELECT doc_id, {_TERMS.format("text")} AS w FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY doc_id, t),
n AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS.format("text")}) AS t FROM benchmark
                                       WHERE item_id IS NOT NULL)),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN w USING (t) JOIN n USING (doc_id), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0)
WHERE r <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query("op12_trie_simhash")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({0}) + 1), lambda i: unicode(substr({0}, i, 1))::BIGINT))," \
       " lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1" \
       " THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
# cost and audit as one string, so that the least is the cheapest and then the ASCII-least
_PAY = lambda n, letter, then: f"lpad((left({then}, 9)::BIGINT + {n})::VARCHAR, 9, '0') || '{letter}' || substr({then}, 10)"


def _least_sql() -> str:
    """One step of the audit from the end: ``b0 .. b3`` are the best (cost, audit) of the rest after nothing, s, u, a."""
    bad = "(fault = 'truncated')::INT"
    gone = "fault IN ('blank', 'duplicate')"
    best = []
    for p in range(4):
        goal, then = ("a", "b3") if p == 2 else ("u", "b2")
        ways = [f"CASE WHEN {gone} THEN NULL WHEN initial = '{goal}' THEN {_PAY(bad, 'K', then)} ELSE {_PAY('2 + ' + bad, 'R', then)} END"]
        if p == 0:
            ways.append(f"CASE WHEN NOT {gone} AND initial = 's' THEN {_PAY(bad, 'K', 'b1')} END")
        best.append(f"least({_PAY(3, 'D', f'b{p}')}, {', '.join(ways)}) AS g{p}")
    return ", ".join(best)


@query("op13_grammar_repair", f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
marked AS (SELECT *, {_CRC.format('k')} % 20 AS m FROM src),
damaged AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
         CASE m WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM marked, unnest(CASE WHEN m = 3 THEN [0, 1] ELSE [0] END) AS u(copy) WHERE m <> 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n, rtrim(text, {_BLANKS}) AS shown, left(role, 1) AS initial FROM damaged),
judged AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM ranked),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
back AS (
  SELECT conv_id, n AS pos, '000000000' AS b0, '000000004II' AS b1, '000000002I' AS b2, '000000000' AS b3 FROM judged WHERE pos = n
  UNION ALL
  SELECT conv_id, pos, least(g0, {_PAY(2, 'I', 'c2')}), least(g1, {_PAY(2, 'I', 'c2')}), c2, least(g3, {_PAY(2, 'I', 'c2')})
  FROM (SELECT *, least(g2, {_PAY(2, 'I', 'g3')}) AS c2
        FROM (SELECT back.conv_id, back.pos - 1 AS pos, {_least_sql()}
              FROM back JOIN judged ON judged.conv_id IS NOT DISTINCT FROM back.conv_id AND judged.pos = back.pos))),
found AS (SELECT conv_id, left(b0, 9)::BIGINT AS cost, substr(b0, 10) AS audit FROM back WHERE pos = 0),
steps AS (
  SELECT conv_id, i, substr(audit, i, 1) AS e, length(replace(left(audit, i), 'I', '')) AS pos,
         length(replace(left(audit, i), 'D', '')) AS nth, length(replace(audit, 'D', '')) AS size
  FROM found, unnest(generate_series(1, length(audit))) AS g(i)),
fixed AS (
  SELECT s.conv_id, string_agg(CASE WHEN e = 'K' THEN j.role WHEN (size - nth) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':'
                               || CASE WHEN e = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY i) AS t
  FROM steps s LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.pos = s.pos WHERE e <> 'D' GROUP BY s.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN found ON found.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM c.conv_id
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "conversations")
    space = F.lit(" ")
    mark = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce("text", space)
    damaged = src.select(
        "conv_id", "turn", F.when(mark == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(mark == 1, "").when(mark == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(mark == 0, F.array().cast("array<int>")).when(mark == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"))
    fixed = repair.repair(damaged)
    said = F.collect_list(F.struct("seq", F.concat("role", F.lit(":"), "text").alias("t")))
    digest = (fixed.edits.filter("edit <> 'D'").groupBy("conv_id")
              .agg(F.array_join(F.transform(F.array_sort(said), lambda r: r["t"]), "\n").alias("t")))
    out = join_null_safe(src.select("conv_id").distinct(), fixed.audits, ["conv_id"], how="left")
    out = join_null_safe(out, digest, ["conv_id"], how="left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.sha2(F.coalesce("t", F.lit("")), 256).alias("repaired_sha256"))
