"""Dictionary (category) encoding.  Ids: P11, P12, T2.

A dictionary is a long table ``(column, value, code)``: per column the sorted distinct
values coded 0..n-1, then the extra levels (``Unknown``, and ``Missing`` if asked) after
them, like an ordered categorical with appended levels.  All columns are encoded at once:
a dictionary of checked size becomes one hash table that every row probes, a larger one
meets the melted cells of the distinct rows in one join.  There is no join per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .schema import _q
from .windows import rank_within

UNKNOWN = "Unknown"
MISSING = "Missing"


def fit_dictionary(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = (UNKNOWN,)) -> DataFrame:
    """``(column, value, code)`` for the distinct non-null values of every column."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(_q(c)).cast("string").alias("value")) for c in cols])).alias("r")
    ).select("r.*").filter(F.col("value").isNotNull()).distinct()
    coded = rank_within(long, "column", ["value"], alias="code", count_alias="__n")
    base = coded.select("column", "value", F.col("code").cast("int").alias("code"))
    if not extra:
        return base
    sizes = coded.groupBy("column").agg(F.max("__n").alias("__n"))
    extras = sizes.select("column", F.posexplode(F.array(*[F.lit(e) for e in extra])).alias("__i", "value")) \
        .join(sizes, "column").select("column", "value", (F.col("__n") + F.col("__i")).cast("int").alias("code"))
    return base.unionByName(extras)


def align_categories(df: DataFrame, dictionary: DataFrame, cols: Sequence[str],
                     unknown: str = UNKNOWN, missing: str | None = MISSING, with_codes: bool = True,
                     table_bytes: int = 4 << 20) -> DataFrame:
    """P12 (+P11 encode): a value outside the training dictionary becomes ``unknown``; a
    null becomes ``missing`` (or stays null when ``missing`` is None).  With
    ``with_codes`` each column also gets ``<col>_code`` from the dictionary (a missing
    level absent from the dictionary codes as -1).

    A dictionary whose values take at most ``table_bytes`` (each counted with 64 bytes of
    overhead) is probed as a table, a larger one is joined; the results are the same.  A value
    that the dictionary holds several times (a real value named like an extra level) has its
    smallest code.  Rows are neither lost nor repeated."""
    cols = list(dict.fromkeys(cols))
    if not cols:
        return df
    place = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    entries = (dictionary.filter(F.col("column").isin(cols) & F.col("value").isNotNull())
               .select(place[F.col("column")].alias("i"), "value", "code")
               .groupBy("i", "value").agg(F.min("code").cast("int").alias("code")))
    ensure_checkpoint_dir(df.sparkSession)
    entries = entries.checkpoint()  # read by the size check, the table and the levels
    levels = entries.filter(F.col("value").isin([v for v in (unknown, missing) if v is not None]))
    room = entries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 64).alias("bytes")).first()
    if (room["bytes"] or 0) <= table_bytes:
        out = _probed_codes(df, entries, room["n"], cols)
    else:
        out = _joined_codes(df, entries, cols)
    # at most two rows per column
    level = levels.agg(F.map_from_entries(F.collect_list(F.struct(_cell_key(F.col("i"), F.col("value")), "code")))).scalar()
    if with_codes:
        out = out.withColumn("__levels", level)
    new = {}
    for i, c in enumerate(cols):
        raw, code = F.col(_q(c)).cast("string"), F.get("__codes", F.lit(i))
        new[c] = F.when(raw.isNull(), F.lit(missing)).when(code.isNull(), F.lit(unknown)).otherwise(raw)
        if with_codes:
            known = F.try_element_at("__levels", _cell_key(F.lit(i), new[c]))
            new[f"{c}_code"] = F.coalesce(code, known, F.lit(-1))
    kept = [c for c in df.columns if c not in new]
    order = [c for c in df.columns] + [c for c in new if c not in df.columns]
    return out.select(*[(F.col(_q(c)) if c in kept else new[c]).alias(c) for c in order])


def _cell_key(i: Column, value: Column) -> Column:
    return F.concat(i.cast("string"), F.lit(":"), value)


def _cells(cols: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("i"), F.col(_q(c)).cast("string").alias("value")) for i, c in enumerate(cols)])


def _probed_codes(df: DataFrame, entries: DataFrame, n: int, cols: Sequence[str]) -> DataFrame:
    """``df`` with ``__codes``, an array in the order of ``cols``, from a hash table in one value: an array of short
    maps, one per hash slot.

    The caller has checked the size of ``entries``.  A look-up reads one slot, so it does not slow down with the
    dictionary as a plain map (searched from its start) would."""
    slots = max(1, n)
    slot = lambda key: F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")
    key = _cell_key(F.col("i"), F.col("value"))
    filled = (entries.select(key.alias("key"), "code").groupBy(slot(F.col("key")).alias("slot"))
              .agg(F.collect_list(F.struct("key", "code")).alias("m")))
    every = entries.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot")).join(filled, "slot", "left")
    table = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "m"))), lambda s: F.map_from_entries(s["m"]))).scalar()

    def look_up(cell):
        k = _cell_key(cell["i"], cell["value"])
        return F.try_element_at(F.get("__table", slot(k)), k)

    return df.withColumn("__table", table).withColumn("__codes", F.transform(_cells(cols), look_up))


def _joined_codes(df: DataFrame, entries: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with ``__codes``, an array in the order of ``cols``, by one join of (column, value) cells.

    Rows with the same cells are one row of the join (named by a SHA-256 of the cells), so repeated rows cost nothing
    and no row number is needed; the second join gives the codes back to the rows."""
    x = df.withColumn("__row", F.sha2(F.to_json(_cells(cols), {"ignoreNullFields": "false"}), 256))
    cells = x.select("__row", *[_q(c) for c in cols]).dropDuplicates(["__row"]) \
        .select("__row", F.explode(_cells(cols)).alias("c")).select("__row", "c.*").filter("value IS NOT NULL")
    found = (cells.join(entries, ["i", "value"]).groupBy("__row")  # at most one entry per column
             .agg(F.map_from_entries(F.collect_list(F.struct("i", "code"))).alias("__m")))
    codes = F.transform(F.sequence(F.lit(0), F.lit(len(cols) - 1)), lambda i: F.try_element_at("__m", i))
    return x.join(found, "__row", "left").withColumn("__codes", codes).drop("__row", "__m")


def new_categories(scoring: DataFrame, training: DataFrame, col: str) -> DataFrame:
    """Distinct values present on the scoring side and absent from training."""
    return scoring.select(_q(col)).distinct().subtract(training.select(_q(col)).distinct())
