"""Keyed result store (S7): results per key, a manifest of finished keys, rebuilds only what is absent or damaged.

Layout below one shared folder: ``data/run=<id>/`` holds the result rows of one computing call, ``manifest/run=<id>/``
its manifest, one row per (key, file) with the key's row count in the file, the number of files that hold the key, and
the file's digest (a key without result rows has one row without a file).  Data are written first, the manifest last:
a key counts only through its manifest rows, so a call that dies leaves nothing that is taken for a result.  A key is
finished if all its files are there with the digest they were written with; of several finished runs the newest counts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import _q, join_null_safe
from .io import _exists


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


class KeyedStore:
    """Results per key (one or more columns) below ``path``, a folder that all executors share.

    ``verify``: ``"content"`` compares the MD5 of every data file, ``"size"`` only its length (no file is opened).
    ``max_rows`` bounds a data file, so that a hot key spreads over several."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], verify: str = "content", max_rows: int = 1_000_000):
        if verify not in ("content", "size"):
            raise ValueError(f"verify is content or size, not {verify!r}")
        self.spark, self.path, self.keys, self.verify, self.max_rows = spark, path.rstrip("/"), list(keys), verify, max_rows

    def _digests(self) -> DataFrame:
        files = (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
                 .load(f"{self.path}/data"))
        digest = F.md5("content") if self.verify == "content" else F.col("length").cast("string")
        return files.select(_name(F.col("path")).alias("file"), digest.alias("digest"))

    def _manifest(self) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/manifest") if _exists(self.spark, f"{self.path}/manifest") else None

    def finished(self) -> DataFrame | None:
        """``keys..., run, files``: for each finished key its newest whole run; None before the first call."""
        manifest = self._manifest()
        if manifest is None:
            return None
        now = self._digests().withColumnsRenamed({"file": "__file", "digest": "__digest"})
        checked = manifest.join(now, F.col("file") == F.col("__file"), "left")
        whole = F.col("file").isNull() | (F.col("digest") == F.col("__digest"))
        per = (checked.groupBy(*map(_q, self.keys), "run")
               .agg(F.sum(F.coalesce(whole, F.lit(False)).cast("int")).alias("__ok"), F.max("n_files").alias("n_files"))
               .filter(F.col("__ok") == F.greatest("n_files", F.lit(1))))
        return per.groupBy(*map(_q, self.keys)).agg(F.max("run").alias("run"))

    def missing(self, wanted: DataFrame) -> DataFrame:
        """The distinct wanted keys that are not finished."""
        keys = wanted.select(*map(_q, self.keys)).distinct()
        done = self.finished()
        return keys if done is None else join_null_safe(keys, done.select(*map(_q, self.keys)), self.keys, "left_anti")

    def get(self, wanted: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The result rows of the wanted keys; ``compute`` gets the keys that are absent or damaged (not called for none) and
        returns their rows, key columns included.  Null keys are a key; repeated wanted keys are one."""
        absent = self.missing(wanted).checkpoint(eager=True)
        if not absent.isEmpty():
            self._build(absent, compute)
        chosen = join_null_safe(self.finished(), wanted.select(*map(_q, self.keys)).distinct(), self.keys)
        manifest = self._manifest().filter("file is not null").select(*map(_q, self.keys), "run", "file")
        places = join_null_safe(manifest, chosen, [*self.keys, "run"])
        schema = self._manifest().select("schema").filter("schema is not null").limit(1).first()
        if schema is None:
            return compute(absent.limit(0)).limit(0)
        from pyspark.sql.types import _parse_datatype_json_string

        # damaged files may be unreadable; whatever is read of them is not among the chosen places
        own = _parse_datatype_json_string(schema["schema"])
        data = (self.spark.read.schema(own).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
                .parquet(f"{self.path}/data").withColumn("__file", _name(F.col("_metadata.file_path"))))
        places = places.withColumnRenamed("file", "__file").drop("run")
        return join_null_safe(data, places, [*self.keys, "__file"], "left_semi").drop("__file")

    def _build(self, absent: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> None:
        run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        rows = compute(absent)
        place = f"{self.path}/data/run={run}"
        rows.write.option("maxRecordsPerFile", self.max_rows).parquet(place)
        written = self.spark.read.schema(rows.schema).parquet(place)
        # keys that were not asked for have no result here
        held = written.withColumn("file", _name(F.col("_metadata.file_path"))).groupBy(*map(_q, self.keys), "file").agg(
            F.count(F.lit(1)).alias("n_rows"))
        held = join_null_safe(held, absent, self.keys)
        held = held.join(self._digests(), "file", "left")
        files = held.groupBy(*map(_q, self.keys)).agg(F.count(F.lit(1)).alias("n_files"))
        out = join_null_safe(held, files, self.keys).withColumn("schema", F.lit(rows.schema.json()))
        none = join_null_safe(absent, files, self.keys, "left_anti").select(
            *map(_q, self.keys), F.lit(None).cast("string").alias("file"), F.lit(0).cast("bigint").alias("n_rows"),
            F.lit(None).cast("string").alias("digest"), F.lit(0).cast("bigint").alias("n_files"), F.lit(None).cast("string").alias("schema"))
        cols = [*map(_q, self.keys), "file", "n_rows", "digest", "n_files", "schema"]
        out = out.select(*cols).unionByName(none.select(*cols)).withColumn("run", F.lit(run))
        out.write.mode("append").parquet(f"{self.path}/manifest")
