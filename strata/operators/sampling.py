"""Id splits and folds.  Ids: M10-M14 (with O4, W6, J5).

Every shuffle is the repeatable order ``md5(seed:key)`` (ties by key); positions come
from the skew-safe :func:`rank_within`, never from an un-partitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schema import _q, join_null_safe
from .windows import Desc, fold_of_rank, rank_within, seeded_rank


def split_ids(df: DataFrame, key: str, fractions: Sequence[float] = (0.6, 0.2, 0.2), seed: int = 1,
              names: Sequence[str] = ("train", "valid", "test"), alias: str = "split") -> DataFrame:
    """Distinct ids shuffled, then cut in order: first ``floor(f0*n)`` ids, then
    ``floor(f1/(f1+f2) * rest)`` of the rest, then the remainder (a 60/20/20 split done as
    a 0.6 split followed by a 0.5 split of the rest)."""
    if len(fractions) != 3 or abs(sum(fractions) - 1) > 1e-9:
        raise ValueError("three fractions summing to 1")
    ids = df.select(_q(key)).distinct()
    r = seeded_rank(ids, key, seed, alias="__r", count_alias="__n")
    n1 = F.floor(F.col("__n") * fractions[0])
    n2 = F.floor((F.col("__n") - n1) * (fractions[1] / (fractions[1] + fractions[2])))
    return r.select(_q(key), F.when(F.col("__r") < n1, F.lit(names[0]))
                    .when(F.col("__r") < n1 + n2, F.lit(names[1])).otherwise(F.lit(names[2])).alias(alias))


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, alias: str = "fold") -> DataFrame:
    """Row-level k-fold: rows in seeded order cut into k parts (``ntile`` sizes)."""
    r = seeded_rank(df, key, seed, alias="__r", count_alias="__n")
    return r.withColumn(alias, fold_of_rank(F.col("__r"), F.col("__n"), k)).drop("__r", "__n")


def stratified_kfold(df: DataFrame, key: str, y: str, k: int = 10, seed: int = 42, alias: str = "fold") -> DataFrame:
    """Within each class, rows in seeded order dealt round-robin over k folds, so
    each fold gets an equal share of every class."""
    r = seeded_rank(df, key, seed, alias="__r", by=y)
    return r.withColumn(alias, (F.col("__r") % k).cast("int")).drop("__r")


def group_kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, alias: str = "fold") -> DataFrame:
    """Distinct group ids shuffled and cut in k parts; every row gets its group's
    fold.  Train rows of fold f = ``fold != f`` (anti), validation = ``fold == f`` (semi)."""
    ids = df.select(_q(key)).distinct()
    r = seeded_rank(ids, key, seed, alias="__r", count_alias="__n")
    folds = r.select(_q(key), fold_of_rank(F.col("__r"), F.col("__n"), k).alias(alias))
    return join_null_safe(df, folds, [key])


def fold_split(df: DataFrame, folds: DataFrame, key: str, fold: int, alias: str = "fold"):
    """(train, valid) rows of one fold via anti / semi joins on the fold's ids."""
    ids = folds.filter(F.col(alias) == fold).select(_q(key))
    return df.join(ids, key, "left_anti"), df.join(ids, key, "left_semi")


def stratified_group_kfold(df: DataFrame, group: str, y: str, k: int = 5, alias: str = "fold") -> DataFrame:
    """Whole groups in one fold with class shares balanced (no shuffle of rows).

    A group's main class is its most frequent one (ties to the smaller).  Groups of a main
    class are ordered by size descending, then a hash of the group, and dealt in a snake over the folds
    (0 .. k-1, k-1 .. 0, ...), so each fold gets every class's groups in even shares and large
    and small groups alternate.  The same rule holds for any number of groups: counts are one
    row per (group, class), ranks come from :func:`rank_within`, and nothing runs in Python.
    Null groups and classes are values like others."""
    counts = df.groupBy(_q(group), _q(y)).agg(F.count(F.lit(1)).alias("__n"))
    top = counts.groupBy(_q(group)).agg(F.sum("__n").alias("__size"), F.max("__n").alias("__top"))
    main = (join_null_safe(counts, top, [group]).filter(F.col("__n") == F.col("__top"))
            .groupBy(_q(group)).agg(F.min(_q(y)).alias("__main"), F.max("__size").alias("__size")))
    r = rank_within(main, "__main", [Desc("__size"), F.md5(F.coalesce(F.col(_q(group)).cast("string"), F.lit(""))), group], alias="__r")
    at = F.col("__r") % (2 * k)
    folds = r.select(_q(group), F.when(at < k, at).otherwise(2 * k - 1 - at).cast("int").alias(alias))
    return join_null_safe(df, folds, [group])
