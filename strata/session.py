"""Spark session helpers.

The library never creates its own cluster settings beyond what a job needs to be
correct: ANSI mode, UTC session time zone, AQE.  On a cluster the session is handed in
by the caller; ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # a checkpoint goes with its DataFrame
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and is used
    as is.  Only a ``local`` session that names none gets a scratch folder; on any other master that is an error,
    because executors do not see each other's folders.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        current = current.get() if current.isDefined() else None
    if not current:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="strata-ckpt-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def materialised(df, what: str = "table"):
    """``df`` written as Parquet to a fresh folder below the session's shared checkpoint folder, and read back: cuts the
    lineage like a checkpoint, in columns."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
