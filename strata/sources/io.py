"""Scans and sinks (S1-S8) and the table-name depth rule.

Every reader returns a lazy DataFrame; nothing is materialised on the driver.  File
listing (S2, S6) touches only file metadata.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.schema import TypeRules, _q, apply_type_rules


def read_table(spark: SparkSession, path: str, typed: bool = False,
               rules: TypeRules | None = None) -> DataFrame:
    """One parquet table, optionally typed by the naming convention."""
    df = spark.read.parquet(path)
    return apply_type_rules(df, rules) if typed else df


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Expand a glob through the Hadoop file system (metadata only, sorted)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath) or []
    return sorted(str(s.getPath().toString()) for s in found)


def read_chunks(spark: SparkSession, pattern: str | Iterable[str], typed: bool = True,
                rules: TypeRules | None = None, fmt: str = "parquet", schema: T.StructType | None = None,
                depth: str | None = None, **options) -> DataFrame:
    """Glob multi-file scan with relaxed vertical union; ``depth`` names a column for each file's depth
    (F24, from its name).

    Parquet: the files are grouped by their own schema (footers, read in one Spark job), each group is
    one scan, its columns are cast to the widened type of :func:`widen_types`, and the groups are
    stacked by name.  A thousand chunks of three schemas are three parallel scans, and any pair of
    types widens (the reader itself refuses bigint + double or two decimals).  The naming-convention
    types (P1) are applied after the union.  Other formats: all files of one read share a schema."""
    paths = list_files(spark, pattern) if isinstance(pattern, str) else list(pattern)
    if not paths:
        raise FileNotFoundError(f"no file matches {pattern!r}")
    if fmt != "parquet":
        out = spark.read.format(fmt).options(**options).load(paths)
        if depth:
            out = out.withColumn(depth, depth_column(F.col("_metadata.file_path")))
        return apply_type_rules(out, rules) if typed else out
    groups = schema_groups(spark, paths)
    target = schema or widened_schema([T._parse_datatype_json_string(s) for s, _ in groups])
    parts = []
    for own, files in groups:
        have = {f.name: f for f in T._parse_datatype_json_string(own).fields}
        part = spark.read.schema(T._parse_datatype_json_string(own)).options(**options).parquet(*files)
        parts.append(part.select(*[(F.col(_q(f.name)).cast(f.dataType) if f.name in have
                                    else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields],
                                 *([depth_column(F.col("_metadata.file_path")).alias(depth)] if depth else [])))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return apply_type_rules(out, rules) if typed else out


def schema_groups(spark: SparkSession, paths: list[str], batch: int = 64) -> list[tuple[str, list[str]]]:
    """(schema as JSON, files) for every distinct schema, by order of the first file.

    Footers are read on the executors, ``batch`` files per task; one row per distinct schema comes back.  A file whose
    footer names no Spark schema, or that lies in a store which only Spark opens, is asked through Spark."""
    import pyarrow as pa

    def footer(path: str) -> str:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        try:
            fs, name = pafs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (pafs.LocalFileSystem(), path)
            if fs.get_file_info(name).type == pafs.FileType.Directory:
                parts = [f.path for f in fs.get_file_info(pafs.FileSelector(name)) if f.base_name.startswith("part-")]
                name = min(parts, default=name)
            with fs.open_input_file(name) as f:
                meta = pq.ParquetFile(f).schema_arrow.metadata or {}
            return meta.get(b"org.apache.spark.sql.parquet.row.metadata", b"").decode()
        except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
            return ""

    def read(rows):
        for b in rows:
            yield pa.record_batch([b.column(0), pa.array([footer(p) for p in b.column(0).to_pylist()], pa.string())],
                                  names=["path", "schema"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths) // batch))
    # folded on the executors: the schema text comes back once per distinct schema, with its files
    found = (listed.mapInArrow(read, "path string, schema string").groupBy("schema")
             .agg(F.array_sort(F.collect_list("path")).alias("files")).collect())
    groups: dict[str, list[str]] = {}
    for own, files in found:
        if own:
            groups.setdefault(own, []).extend(files)
        else:
            for p in files:
                groups.setdefault(spark.read.parquet(p).schema.json(), []).append(p)
    place = {p: i for i, p in enumerate(paths)}
    return sorted(((own, sorted(files, key=place.get)) for own, files in groups.items()), key=lambda g: place[g[1][0]])


# Numeric widening order (a column seen with two of these types takes the
# later one); any other disagreement falls back to string.
_NUMERIC_ORDER = ("tinyint", "smallint", "int", "bigint", "float", "double")
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def widen_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The common type of one column seen with types ``a`` and ``b`` in two chunks.  Decimals stay decimal with
    each other and with whole numbers as long as 38 digits hold both; beyond that they are double."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    sa, sb = a.simpleString(), b.simpleString()
    if "decimal" in sa[:7] + sb[:7]:
        dec = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType)
               else (_DIGITS[x.simpleString()], 0) if x.simpleString() in _DIGITS else None for x in (a, b)]
        if None not in dec:
            whole, scale = max(d[0] for d in dec), max(d[1] for d in dec)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
        if all(s in _NUMERIC_ORDER or s.startswith("decimal") for s in (sa, sb)):
            return T.DoubleType()
    if sa in _NUMERIC_ORDER and sb in _NUMERIC_ORDER:
        wide = max(sa, sb, key=_NUMERIC_ORDER.index)
        if wide == "float" and "bigint" in (sa, sb) or wide == "float" and "int" in (sa, sb):
            wide = "double"  # a float does not hold all whole numbers of 32 or 64 bits
        return T._parse_datatype_string(wide)
    if {sa, sb} <= {"date", "timestamp"}:
        return T.TimestampType()
    if {sa, sb} <= {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    return T.StringType()


def widened_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """Union schema by name (first-seen column order), each column widened."""
    types: dict[str, T.DataType] = {}
    for sch in schemas:
        for f in sch.fields:
            types[f.name] = widen_types(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t, True) for n, t in types.items()])


def read_csv(spark: SparkSession, path: str, schema=None, infer: bool = True, multi_line: bool = True) -> DataFrame:
    """S3: CSV with header and quoted fields; whitespace inside fields is kept.  Quoted line breaks need
    ``multi_line`` (one task per file); without them ``multi_line=False`` lets a large file be split."""
    reader = (spark.read.option("header", True).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Parquet sink (array columns included)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S4 (CSV form): header, quotes doubled inside quoted fields, whitespace kept (the
    writer trims by default), empty strings quoted so they read back as empty, not null."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_submission(df: DataFrame, path: str, cols: list[str], mode: str = "overwrite") -> None:
    """CSV result file holding only ``cols`` (with header)."""
    write_csv(df.select(*cols), path, mode)


def file_inventory(spark: SparkSession, root: str, glob: str = "*",
                   path_regex: str | None = None, names: list[str] | None = None,
                   recursive: bool = True) -> DataFrame:
    """List files under ``root`` and parse ids out of their paths.

    Only ``path`` and ``length`` are selected, so file contents are never read.  Each
    capture group of ``path_regex`` becomes a column (``names``); digits are cast to long.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(recursive).lower()).load(root)
          .select("path", "length"))
    if path_regex:
        names = names or [f"part{i + 1}" for i in range(re.compile(path_regex).groups)]
        df = df.select("path", "length", *[
            F.expr(f"try_cast(nullif(regexp_extract(path, '{_sql_escape(path_regex)}', {i + 1}), '') as bigint)")
            .alias(n) for i, n in enumerate(names)])
    return df


def cached(spark: SparkSession, df_fn: Callable[[], DataFrame], path: str) -> DataFrame:
    """Compute once, reuse if present; an entry of which any file is unreadable is recomputed.

    The cache lives in a shared folder (give one under ``spark.checkpoint.dir`` on a
    cluster), so a lost executor never loses it.
    """
    if _exists(spark, path + "/_SUCCESS"):
        try:
            df = spark.read.parquet(path)
            df.count()  # reads the footer of every file, no data
            return df
        except (PySparkException, Py4JJavaError):  # corrupt entry -> recompute
            pass
    df_fn().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def depth_from_name(name: str) -> int | None:
    """depth digit after a word character and ``_`` in a table name; None if absent."""
    m = re.search(r"\w_(\d)", name.rsplit("/", 1)[-1])
    return int(m.group(1)) if m else None


def depth_column(path: Column) -> Column:
    """F24 per row: the depth in the table name of a file path (part files belong to their folder's name)."""
    name = F.element_at(F.split(F.regexp_replace(path, "/part-[^/]*$", ""), "/"), -1)
    return F.nullif(F.regexp_extract(name, r"\w_(\d)", 1), F.lit("")).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def _sql_escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")
