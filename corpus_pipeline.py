"""Corpus pipeline over ``documents``: toxicity, near-duplicates, repeated strings, benchmark passages, piece ids.

Each stage takes what the one before it kept (written as Parquet and read again).  All but the last return the columns
of ``documents``; a text that loses bytes gets a new ``n_chars``, a null text becomes empty in the third stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm import dartminhash, decontaminate, segment, suffix_dedup, toxicity
from strata.llm.tokens import scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REST = ["text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window scores below one half."""
    net = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5, fold=0)
    out = toxicity.score_toxicity(docs, net, folds=5, fold=0, keep=REST)
    return out.filter("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one of smallest doc_id; of identical rows one."""
    no_id = F.lit(-(1 << 63)).cast("bigint")
    kept = (dartminhash.near_duplicates(docs).filter("kept")
            .select(F.coalesce("doc_id", no_id).alias("kid"), "th").distinct())
    x = docs.select(*COLUMNS, F.coalesce("doc_id", no_id).alias("kid"),
                    F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")).join(kept, ["kid", "th"], "left_semi")
    same = Window.partitionBy("kid", "th").orderBy("lang", "source", "n_chars")
    return x.withColumn("nth", F.row_number().over(same)).filter("nth = 1").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the 100-byte strings that also start earlier."""
    out = suffix_dedup.remove_repeats(docs, size=100, keep=["lang", "source", "n_chars"], with_text=True)
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("bigint")).otherwise(F.col("n_chars"))
    return out.select("doc_id", F.col("kept").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten benchmark words occurs."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, keep=REST,
                                        item_form="none")
    return found.filter(F.size("spans") == 0).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, with ids, scores and the decoding check."""
    return segment.sample_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2, with_ids=True)


STAGES = [("toxicity", drop_toxic), ("minhash_near_dedup", drop_near_duplicates), ("suffix_array_dedup", cut_repeats),
          ("benchmark_decontamination", drop_contaminated), ("sentencepiece", encode_pieces)]

# trained scores, hashed signatures and sampled segmentations are not SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        place = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
