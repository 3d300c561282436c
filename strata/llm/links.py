"""Graph and filter helpers on DataFrames: connected components, bounded key filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


PER_TASK = 1 << 18


def tasks_for(rows: int, spark) -> int:
    """Partitions for a table of so many short rows."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PER_TASK)))


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` of every node in ``edges`` (columns a, b): ``comp`` is the smallest node of its component.

    Alternating large-star and small-star steps, each a grouped minimum and a join; every round is checkpointed and
    the driver sees only a count and a checksum.  A hub is never gathered: its edges stay rows.  Tasks and files of a
    round follow the number of edges, so that a small graph does not cost a full set of both per step."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    parts = tasks_for(edges.count(), spark)
    e = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = e.coalesce(parts).distinct().coalesce(parts).checkpoint(eager=True)
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v"))
                 .coalesce(parts).distinct().coalesce(parts))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = (small.filter(F.col("v") != F.col("m"))
             .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
             .unionByName(small.select("u", F.col("m").alias("v"))).coalesce(parts).distinct().coalesce(parts)).checkpoint(eager=True)
        state = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == (state["n"], state["h"]):
            break
        mark = (state["n"], state["h"])
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def key_bitmap(keys: DataFrame, col: str, log2_bits: int = 26):
    """A bitmap over hashes of a bigint column, at most 2^log2_bits bits whatever the number of keys, as a broadcast
    of unsigned words.  It never misses a key; :func:`may_hold` may let others pass, so a join must follow."""
    bit = F.pmod(F.xxhash64(F.col(col)), F.lit(1 << log2_bits))
    rows = (keys.groupBy(F.shiftright(bit, 6).alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int"))).alias("bits")))
    got = rows.toArrow()
    words = np.zeros(1 << (log2_bits - 6), np.uint64)
    words[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(words), log2_bits


def may_hold(bitmap: np.ndarray, log2_bits: int, hashes: np.ndarray) -> np.ndarray:
    """Whether each xxhash64 value's bit is set."""
    bit = hashes.astype(np.int64) % (1 << log2_bits)
    return (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1


def filtered(df: DataFrame, hash_col: str, bitmap, invert: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``hash_col`` (an xxhash64) may be among the bitmap's keys, or with ``invert`` all others."""
    held, log2_bits = bitmap

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(hash_col)
            ok = may_hold(held.value, log2_bits, batch.column(at).to_numpy())
            yield batch.filter(pa.array(~ok if invert else ok))

    return df.mapInArrow(run, df.schema)
