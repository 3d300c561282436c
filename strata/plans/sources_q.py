"""Source / sink round trips.

Each query writes tables derived from the driver tables to a fresh folder under the
session's shared ``spark.checkpoint.dir`` (a distributed folder on a cluster; the write
is eager, through Spark's committer, so a lost executor only re-runs its tasks), then
reads them back through the source under test.  The oracle is the source table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import io
from ..sources.store import KeyedStore
from .catalog import query, rounded, table


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io-{what}-{uuid.uuid4().hex}"


# -------------------------------------------------------------- S2 + F24: chunked read

@query("read_chunks", "S2 F24 T1", sql="""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE)
  AS l_extendedprice, l_returnflag, CAST(l_suppkey % 2 + 1 AS INTEGER) AS depth FROM lineitem""")
def read_chunks_q(spark, sf):
    """lineitem written as 4 chunk files ``lineitem_<depth>_<i>`` by ``l_suppkey % 4``, which store
    ``l_quantity`` as int, bigint, float and double and the price as decimals of three shapes, so
    the union must widen.  The depth comes from each file's own name (F24)."""
    root = _scratch(spark, "chunks")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                              "l_returnflag", "l_suppkey")
    kinds = [("int", "decimal(12,2)"), ("bigint", "decimal(14,4)"), ("float", "decimal(12,2)"), ("double", "decimal(10,2)")]
    for i, (quantity, price) in enumerate(kinds):
        part = li.filter(F.col("l_suppkey") % 4 == i).drop("l_suppkey")
        part = (part.withColumn("l_quantity", F.col("l_quantity").cast(quantity))
                .withColumn("price", F.col("l_extendedprice").cast(price)))
        io.write_parquet(part.drop("l_extendedprice"), f"{root}/lineitem_{i % 2 + 1}_{i}.parquet")
    df = io.read_chunks(spark, io.list_files(spark, f"{root}/lineitem_*_*.parquet"), typed=False, depth="depth")
    return df.withColumn("l_extendedprice", F.col("price").cast("double")).drop("price")


# -------------------------------------------------------------- S3 + S5: CSV

@query("csv_round_trip", "S3 S4", sql="SELECT CAST(doc_id AS INTEGER) AS doc_id, lang, source, text FROM documents")
def csv_round_trip(spark, sf):
    """documents (multi-line text with quotes and commas) to CSV and back with inferred
    types."""
    path = _scratch(spark, "csv")
    io.write_csv(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"), path)
    return io.read_csv(spark, path)


@query("submission", "S5 S3", sql="""
SELECT CAST(o_orderkey AS INTEGER) AS case_id, round(o_totalprice, 4) AS score FROM orders""")
def submission(spark, sf):
    """Score file with a column subset (``case_id, score``), read back."""
    path = _scratch(spark, "submission")
    scores = table(spark, sf, "orders").select(F.col("o_orderkey").alias("case_id"),
                                               F.col("o_totalprice").alias("score"), "o_orderpriority")
    io.write_submission(scores, path, ["case_id", "score"])
    return rounded(io.read_csv(spark, path), 4)


# -------------------------------------------------------------- S6: file inventory

@query("file_inventory", "S6 F13", sql="""
SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS line, l_suppkey % 10 AS bucket, true AS has_files FROM lineitem""")
def file_inventory_q(spark, sf):
    """lineitem written partitioned into ``line=<n>/bucket=<k>/`` folders; the inventory
    lists the files (metadata only) and parses both ids out of each path."""
    root = _scratch(spark, "inventory")
    li = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("line"),
                                              (F.col("l_suppkey") % 10).alias("bucket"), "l_orderkey")
    io.write_parquet(li, root, partition_by=["line", "bucket"])
    inv = io.file_inventory(spark, root, "*.parquet", r"line=(\d+)/bucket=(\d+)/", ["line", "bucket"])
    return inv.groupBy("line", "bucket").agg((F.count(F.lit(1)) > 0).alias("has_files"))


# -------------------------------------------------------------- S7: keyed result cache

@query("cache_round_trip", "S7", sql="""
SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY o_custkey""")
def cache_round_trip(spark, sf):
    """An aggregate computed once into the cache folder; the second call reads it."""
    path = _scratch(spark, "cache")

    def build():
        return (table(spark, sf, "orders").groupBy("o_custkey")
                .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 4).alias("total")))

    io.cached(spark, build, path)
    return io.cached(spark, lambda: (_ for _ in ()).throw(RuntimeError("cache miss")), path)


def _half_then_all(spark, sf):
    """A store of order totals per customer: half of the customers asked for, one file damaged, then all asked for.
    Returns (store, all keys, keys finished before the damage, keys finished after it, keys the last call computed)."""
    path = _scratch(spark, "store")
    orders = table(spark, sf, "orders")
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    store = KeyedStore(spark, path, ["o_custkey"])
    asked = []

    def compute(absent):
        asked.append(absent)
        return (orders.join(absent, "o_custkey").groupBy("o_custkey")
                .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 4).alias("total")))

    store.get(keys.filter("o_custkey % 2 = 0"), compute)
    before = store.finished().checkpoint(eager=True)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    victim = hpath(io.list_files(spark, f"{path}/data/run=*/*.parquet")[0])
    out = victim.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(victim, True)
    out.writeBytes("no parquet file any more")
    out.close()
    after = store.finished().checkpoint(eager=True)
    rows = store.get(keys, compute)
    return rows, keys, before, after, asked


@query("store_rows", "S7", sql="""
SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 4) AS total FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_custkey""")
def store_rows(spark, sf):
    """Every customer's row is right although half were stored before and one stored file was damaged."""
    return _half_then_all(spark, sf)[0]


@query("store_rebuilds", "S7", sql="""
SELECT count(*) AS keys, count(*) FILTER (c_custkey % 2 = 0) AS stored, true AS some_damaged, true AS only_needed, 2 AS calls
FROM customer""")
def store_rebuilds(spark, sf):
    """The second call computed the absent and the damaged keys and no other."""
    _, keys, before, after, asked = _half_then_all(spark, sf)
    lost = before.join(after, "o_custkey", "left_anti").select("o_custkey")
    needed = lost.unionByName(keys.filter("o_custkey % 2 = 1")).distinct()
    differ = needed.exceptAll(asked[1]).unionByName(asked[1].exceptAll(needed))
    return keys.agg(F.count(F.lit(1)).alias("keys")).select(
        "keys", before.select(F.count(F.lit(1))).scalar().alias("stored"), (lost.select(F.count(F.lit(1))).scalar() > 0).alias("some_damaged"),
        (differ.select(F.count(F.lit(1))).scalar() == 0).alias("only_needed"), F.lit(len(asked)).alias("calls"))


# -------------------------------------------------------------- S8: array columns

@query("list_round_trip", "S8 A13", sql="""
SELECT l_orderkey, list(l_partkey ORDER BY l_partkey) AS partkeys,
  list(l_extendedprice ORDER BY l_partkey, l_extendedprice) AS prices FROM lineitem GROUP BY l_orderkey""")
def list_round_trip(spark, sf):
    """Per order, the sorted part keys and prices as arrays, written and read back."""
    path = _scratch(spark, "lists")
    li = table(spark, sf, "lineitem")
    arr = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_partkey", "l_extendedprice"))).alias("__s"))
    out = arr.select("l_orderkey", F.col("__s.l_partkey").alias("partkeys"),
                     F.col("__s.l_extendedprice").alias("prices"))
    io.write_parquet(out, path)
    return spark.read.parquet(path)
