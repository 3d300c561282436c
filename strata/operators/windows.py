"""Ranking, sampling-by-position and ordering operators.

Ids: W1-W6, O1, O3, O4, O5 and the shared :func:`rank_within`.

``row_number().over(Window.partitionBy(g).orderBy(o))`` sorts each whole group inside one
task, and without ``partitionBy`` the whole table goes to a single task.  Both break when
one group holds a large share of the rows.  :func:`rank_within` counts the groups first (map-side combined): rows of
groups of at most ``HOT_ROWS`` rows are ranked by a window, whose tasks then stay small, and may use a partitioning that
the rows already have; the rows of larger groups, and of a table ranked as one group, take this way:

1. range-partition the rows on ``(group..., order..., tiebreak...)`` and sort inside each
   partition - a hot group is spread over many consecutive partitions;
2. number the rows inside each partition (``monotonically_increasing_id`` is
   ``partition_id << 33 | local_index`` and is deterministic because the sort is total);
3. count rows per (partition, group) - a table of at most ``partitions + groups`` rows -
   and turn it into per-(partition, group) offsets with a running sum over partitions;
4. join the offsets back on (partition, group): rank = offset + local index.

Step 1-2 are materialised once with ``checkpoint()`` so both uses see the same rows.

No larger group is ever gathered in one task and nothing is collected to the driver.  Null group keys form a group of
their own (the offsets are joined null-safe).
:func:`running_sum_within` is the same scheme for running sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir
from .schema import _q, join_null_safe


HOT_ROWS = 1 << 20  # a group up to this size is ranked within one task


def _cols(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def _as_col(c) -> Column:
    return F.col(_q(c)) if isinstance(c, str) else c


class Desc:
    """Marks an order item as descending in :func:`rank_within`."""

    def __init__(self, col):
        self.col = col


def split_hot(df: DataFrame, by: Sequence, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """``df`` without the rows of the groups of more than ``hot_rows`` rows, and those rows (None if there are none)."""
    names = [f"__h{i}" for i in range(len(by))]
    sizes = df.select(*[_as_col(b).alias(n) for b, n in zip(by, names)]).groupBy(*names).agg(F.count(F.lit(1)).alias("__size"))
    ensure_checkpoint_dir(df.sparkSession)
    hot = sizes.filter(F.col("__size") > hot_rows).select(*names).checkpoint()  # at most one row per hot_rows rows
    if hot.isEmpty():
        return df, None
    same = None
    for b, n in zip(by, names):
        c = _as_col(b).eqNullSafe(F.col(n))
        same = c if same is None else same & c
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def rank_within(df: DataFrame, by=None, order=None, alias: str = "rank", count_alias: str | None = None,
                partitions: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """0-based row rank inside each ``by`` group in ``order`` (which must be a total
    order; add a unique column last).  Wrap an order item in :class:`Desc` for descending.
    Optionally adds the group size as ``count_alias``.  Rows with a null group key form one
    group.  Skew-safe; see the module notes."""
    by, order = _cols(by), _cols(order)
    if not order:
        raise ValueError("rank_within needs an order")
    if not by:
        return _rank_by_ranges(df, by, order, alias, count_alias, partitions)
    small, hot = split_hot(df, by, hot_rows)
    group = Window.partitionBy(*[_as_col(b) for b in by])
    w = group.orderBy(*[_as_col(o.col).desc() if isinstance(o, Desc) else _as_col(o).asc() for o in order])
    new = {alias: F.row_number().over(w).cast("bigint") - 1}
    if count_alias:
        new = {count_alias: F.count(F.lit(1)).over(group), **new}
    out = small.withColumns(new)
    return out if hot is None else out.unionByName(_rank_by_ranges(hot, by, order, alias, count_alias, partitions))


def _rank_by_ranges(df: DataFrame, by: list, order: list, alias: str, count_alias: str | None, partitions: int | None) -> DataFrame:
    """:func:`rank_within` by ranges of (group, order)."""
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tmp_by = [f"__g{i}" for i in range(len(by))]
    tmp_ord = [f"__o{i}" for i in range(len(order))]
    x = df.select("*", *[_as_col(b).alias(t) for b, t in zip(by, tmp_by)],
                  *[_as_col(o.col if isinstance(o, Desc) else o).alias(t) for o, t in zip(order, tmp_ord)])
    sort_cols = [F.col(g) for g in tmp_by] + [F.col(t).desc() if isinstance(o, Desc) else F.col(t).asc()
                                              for o, t in zip(order, tmp_ord)]
    # The range bounds are sampled per exchange (seeded by the RDD id), so the counts and
    # the rows must come from one materialised exchange: a reliable checkpoint in the
    # session's shared checkpoint folder (survives executor loss, cuts the lineage).
    ensure_checkpoint_dir(df.sparkSession)
    x = (x.repartitionByRange(n_parts, *sort_cols).sortWithinPartitions(*sort_cols)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__mid", F.monotonically_increasing_id())).checkpoint(eager=True)
    counts = x.groupBy("__pid", *tmp_by).agg(F.count(F.lit(1)).alias("__c"), F.min("__mid").alias("__m0"))
    w = Window.partitionBy(*tmp_by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offs = counts.withColumn("__off", F.sum("__c").over(w) - F.col("__c"))
    if count_alias:
        offs = offs.withColumn("__n", F.sum("__c").over(Window.partitionBy(*tmp_by)))
    keep = ["__pid", *tmp_by, "__off", "__m0"] + (["__n"] if count_alias else [])
    joined = join_null_safe(x, offs.select(*keep), ["__pid", *tmp_by])
    out = joined.withColumn(alias, F.col("__off") + F.col("__mid") - F.col("__m0"))
    if count_alias:
        out = out.withColumnRenamed("__n", count_alias)
    return out.drop("__pid", "__mid", "__off", "__m0", *tmp_by, *tmp_ord)


def running_sum_within(df: DataFrame, by: Sequence[str], order: str, value: str, alias: str) -> DataFrame:
    """Exclusive running sum of ``value`` inside each ``by`` group in ``order`` (unique
    within the group): range-partition on (by, order), running sums inside each
    partition, plus per-(partition, group) offsets from the partitions before.  The
    partitioned frame is checkpointed once so both uses see the same partitions."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(_q(b)) for b in by] + [F.col(_q(order))]
    x = df.repartitionByRange(n, *keys).withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    w_local = (Window.partitionBy("__pid", *[_q(b) for b in by]).orderBy(_q(order))
               .rowsBetween(Window.unboundedPreceding, -1))
    local = x.withColumn("__loc", F.coalesce(F.sum(_q(value)).over(w_local), F.lit(0)))
    tot = x.groupBy("__pid", *[_q(b) for b in by]).agg(F.sum(_q(value)).alias("__t"))
    w_off = Window.partitionBy(*[_q(b) for b in by]).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.withColumn("__off", F.coalesce(F.sum("__t").over(w_off), F.lit(0))).drop("__t")
    return (join_null_safe(local, offs, ["__pid", *by]).withColumn(alias, F.col("__off") + F.col("__loc"))
            .drop("__pid", "__loc", "__off"))


def with_group_size(df: DataFrame, key, alias: str = "group_size") -> DataFrame:
    """Group size on every row (aggregate + join, not a window over the group)."""
    key = _cols(key)
    sizes = df.groupBy(*[_q(k) for k in key]).agg(F.count(F.lit(1)).alias(alias))
    return join_null_safe(df, sizes, key)


def fold_of_rank(rank: Column, n: Column, k: int) -> Column:
    """``ntile(k) - 1`` from a 0-based rank of n: the first ``n % k`` parts get one more."""
    b = F.floor(n / k)
    m = n - b * k
    big = m * (b + 1)
    return F.when(rank < big, F.floor(rank / (b + 1))).otherwise(m + F.floor((rank - big) / b)).cast("int")


def split_folds(df: DataFrame, k: int, order, by=None, alias: str = "fold") -> DataFrame:
    """Even split of the ordered rows into ``k`` parts (sizes as ``ntile``)."""
    r = rank_within(df, by, order, alias="__r", count_alias="__n")
    return r.withColumn(alias, fold_of_rank(F.col("__r"), F.col("__n"), k)).drop("__r", "__n")


def sample_evenly(df: DataFrame, key, order, k: int = 10, alias: str = "slot") -> DataFrame:
    """``k`` items per group at equal intervals of the ordered items.

    For n items the j-th pick (j = 1..k) is item ``max(0, rint(j*n/k - 0.5001))`` (0-based,
    round half to even); a group with fewer than k items repeats items.  Each output row
    carries ``slot`` = j - 1.
    """
    key = _cols(key)
    r = rank_within(df, key, order, alias="__r", count_alias="__n")
    # each row emits the slots that pick it (no per-group slot table to join back)
    picks = F.filter(F.sequence(F.lit(1), F.lit(k)),
                     lambda j: F.greatest(F.lit(0.0), F.rint(j * F.col("__n") / F.lit(float(k)) - F.lit(0.5001)))
                     == F.col("__r").cast("double"))
    return (r.withColumn("__js", picks).select("*", F.explode("__js").alias("__j"))
            .withColumn(alias, F.col("__j") - 1).drop("__js", "__j", "__r", "__n"))


def thin(df: DataFrame, key, order, factor: int = 1, max_rows: float | None = None) -> DataFrame:
    """Keep every n-th row of each group (rows 0, n, 2n, ...) with ``n = factor``; with
    ``max_rows`` (off unless given) ``n = max(factor, ceil(count / max_rows))``."""
    key = _cols(key)
    r = rank_within(df, key, order, alias="__r", count_alias="__n")
    step = F.lit(factor) if max_rows is None else F.greatest(F.lit(factor), F.ceil(F.col("__n") / F.lit(max_rows)))
    return r.filter(F.col("__r") % step == 0).drop("__r", "__n")


def natural_sort_key(col) -> Column:
    """O3: digit runs compare as numbers of any length.  The text is split into digit and
    non-digit runs; each run is a (digits, text) pair, where a digit run without its leading
    zeros is led by its length, and order by the resulting array."""
    c = _as_col(col)
    parts = F.regexp_extract_all(c, F.lit(r"\d+|\D+"), 0)

    def run(x):
        bare = F.regexp_replace(x, "^0+(?=.)", "")
        number = x.rlike(r"^\d+$")
        return F.struct(F.when(number, F.length(bare)).otherwise(F.lit(0)).alias("size"),
                        F.when(number, bare).otherwise(x).alias("run"))

    return F.transform(parts, run)


def seeded_rank(df: DataFrame, key: str, seed, alias: str = "rank", by=None, count_alias: str | None = None) -> DataFrame:
    """0-based position in a repeatable shuffle: order by ``md5(seed:key)``, then key."""
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col(_q(key)).cast("string"))), F.col(_q(key))]
    return rank_within(df, by, order, alias=alias, count_alias=count_alias)


def with_length_batches(df: DataFrame, text: str, key: str, size: int = 16, alias: str = "batch") -> DataFrame:
    """Longest-first batching: rank by (length desc, key), batch = rank div size.  The
    original order is kept by ``key`` (restore with a join or an order by key)."""
    r = rank_within(df, None, [Desc(F.length(_q(text))), F.col(_q(key))], alias="__r")
    return r.withColumn(alias, F.floor(F.col("__r") / size).cast("int")).withColumnRenamed("__r", "length_rank")
