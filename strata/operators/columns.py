"""Column operators: date offsets, data-driven pruning, calendar features, filters,
sentinels, value maps, key-driven picks, seeded samples, required fields.

Ids: P2, P3, P4, P14, P15, P16, P17, P18, P20, P22, P23, P24, F14.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import _q


def day_offset(col: Column, ref: Column, is_mean: bool = False) -> Column:
    """Whole days ``col - ref`` (negative = earlier).

    A mean date (A5) is carried as fractional days since the epoch; it is shifted and
    truncated toward zero, like a duration's total days.
    """
    if is_mean:
        return (col - F.unix_date(ref)).cast("int")
    return F.datediff(col, ref)


def dates_to_offsets(df: DataFrame, ref_col: str = "date_decision", cols: Iterable[str] | None = None,
                     drop: Iterable[str] = ("date_decision", "MONTH"), suffix: str = "D") -> DataFrame:
    """Every ``*D`` column (dates and mean-date doubles) becomes whole days relative
    to ``ref_col``; then the reference date and ``MONTH`` are dropped.  One projection."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    targets = set(cols) if cols is not None else {c for c in df.columns if c.endswith(suffix)}
    targets.discard(ref_col)
    ref = F.col(_q(ref_col))
    out = []
    for name in df.columns:
        if name in targets:
            dt = fields[name]
            if isinstance(dt, (T.DoubleType, T.FloatType)):
                out.append(day_offset(F.col(_q(name)), ref, is_mean=True).alias(name))
            else:
                out.append(day_offset(F.col(_q(name)).cast("date"), ref).alias(name))
        elif name not in set(drop):
            out.append(F.col(_q(name)))
    return df.select(*out)


def prune_report(df: DataFrame, keep: Iterable[str] = ("target", "case_id", "WEEK_NUM"),
                 max_null: float = 0.95, max_card: int = 200) -> DataFrame:
    """P3 report: ``(column, null_share, n_unique, dropped)`` for every candidate column.

    One aggregate gives the null shares.  The distinct values of the surviving string columns
    (null counted as a value) are counted exactly in one job for all of them: rows of
    (column, digest of the value), made distinct map-side first, so neither long values nor a
    column's value set travel.  ``n_unique`` is null for columns that are not strings or that
    their null share already drops."""
    keep = set(keep)
    cand = [f for f in df.schema.fields if f.name not in keep]
    stats = df.agg(*[F.avg(F.col(_q(f.name)).isNull().cast("double")).alias(f"n{i}")
                     for i, f in enumerate(cand)]).first() if cand else None  # one row
    share = {f.name: 1.0 if stats[f"n{i}"] is None else float(stats[f"n{i}"]) for i, f in enumerate(cand)}
    strings = [f.name for f in cand if isinstance(f.dataType, T.StringType) and share[f.name] <= max_null]
    n_unique: dict[str, int] = {}
    if strings:
        cells = F.array(*[F.struct(F.lit(i).alias("i"), F.md5(F.col(_q(c)).cast("binary")).alias("v"))
                          for i, c in enumerate(strings)])
        found = df.select(F.explode(cells).alias("c")).select("c.i", "c.v").distinct().groupBy("i").count().collect()
        n_unique = {strings[r["i"]]: r["count"] for r in found}  # one row per column
    rows = []
    for f in cand:
        n = n_unique.get(f.name)
        dropped = share[f.name] > max_null or (n is not None and (n == 1 or n > max_card))
        rows.append((f.name, share[f.name], n, dropped))
    return df.sparkSession.createDataFrame(
        rows, "column string, null_share double, n_unique bigint, dropped boolean")


def prune_columns(df: DataFrame, keep: Iterable[str] = ("target", "case_id", "WEEK_NUM"),
                  max_null: float = 0.95, max_card: int = 200) -> DataFrame:
    """Drop columns with null share above ``max_null``; then string columns whose
    distinct count (null counted) is 1 or above ``max_card``.  ``keep`` is protected."""
    report = prune_report(df, keep, max_null, max_card)
    dropped = {r["column"] for r in report.filter("dropped").select("column").collect()}
    return df.select(*[_q(c) for c in df.columns if c not in dropped])


def add_calendar(df: DataFrame, col: str = "date_decision", at: int = 5,
                 names: tuple[str, str] = ("month_decision", "weekday_decision")) -> DataFrame:
    """Month (1-12) and ISO weekday (Monday=1..Sunday=7) placed at positions ``at``
    and ``at + 1``."""
    d = F.col(_q(col)).cast("date")
    new = [F.month(d).alias(names[0]), (F.weekday(d) + 1).alias(names[1])]
    rest = [_q(c) for c in df.columns if c not in names]
    cols = [F.col(c) for c in rest]
    pos = min(at, len(cols))
    return df.select(*cols[:pos], *new, *cols[pos:])


def filter_ordinal(df: DataFrame, col: str = "num_group1", value=0,
                   rename: Mapping[str, str] | None = None) -> DataFrame:
    """Keep rows whose ordinal equals ``value``, drop the ordinal, rename columns."""
    out = df.filter(F.col(_q(col)) == F.lit(value)).drop(col)
    return out.withColumnsRenamed(dict(rename)) if rename else out


def fill_sentinel(df: DataFrame, value, cols: Iterable[str] | None = None) -> DataFrame:
    """Null -> sentinel (e.g. -100 ignored label, -1 no label) in numeric columns."""
    return df.fillna(value, subset=list(cols) if cols is not None else None)


def map_values(df: DataFrame, cols: Iterable[str], mapping: Mapping, on_missing: str = "null",
               out_type: str | None = None) -> DataFrame:
    """Replace values through a fixed mapping.

    ``on_missing``: ``null`` (unknown -> null), ``keep`` (unknown kept) or ``error``
    (unknown non-null value raises, like a dictionary look-up failure).  Null stays null.
    """
    cols = set(cols)
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    table = F.create_map(*pairs)

    def conv(name: str) -> Column:
        c = F.col(_q(name))
        hit = F.try_element_at(table, c)
        if on_missing == "keep":
            res = F.coalesce(hit, c)
        elif on_missing == "error":
            res = F.when(c.isNull(), F.lit(None)).when(hit.isNull(), F.raise_error(
                F.concat(F.lit(f"unmapped value in {name}: "), c.cast("string")))).otherwise(hit)
        else:
            res = hit
        return (res.cast(out_type) if out_type else res).alias(name)

    return df.select(*[conv(c) if c in cols else F.col(_q(c)) for c in df.columns])


def pick_by_key(df: DataFrame, key: str, choices: Mapping[str, str], alias: str = "picked") -> DataFrame:
    """P20: value of the column named by ``choices[key value]``; unknown key -> null."""
    expr = None
    for k, col in choices.items():
        cond = F.col(_q(key)) == F.lit(k)
        expr = F.when(cond, F.col(_q(col))) if expr is None else expr.when(cond, F.col(_q(col)))
    return df.withColumn(alias, expr)


def seeded_order(key: Column | str, seed: int | str) -> Column:
    """Repeatable, engine-neutral shuffle order: ``md5(seed || ':' || key)``."""
    k = F.col(_q(key)) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` seeded rows: smallest ``md5(seed:key)``, ties by key.

    ``orderBy(...).limit(n)`` plans as a ``TakeOrderedAndProject`` (per-partition top-n,
    then merge of n rows per partition), not a full sort.
    """
    return df.orderBy(seeded_order(key, seed), F.col(_q(key))).limit(n)


def require_fields(df: DataFrame, cols: Iterable[str], check_empty: bool = True) -> DataFrame:
    """Rows missing any required field are skipped; a required column that does
    not exist raises, and so does an empty result (checked with ``isEmpty``, which stops
    at the first row)."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"required columns absent: {missing}")
    out = df.dropna(subset=cols)
    if check_empty and out.isEmpty():
        raise ValueError("no row has all required fields")
    return out


def split_features(df: DataFrame, label: str = "target", key: str = "case_id",
                   group: str = "WEEK_NUM") -> tuple[DataFrame, DataFrame]:
    """(key/group/label frame, feature frame).  Both keep the key so they rejoin."""
    meta = [c for c in (key, group, label) if c in df.columns]
    feats = [c for c in df.columns if c not in (group, label)]
    return df.select(*[_q(c) for c in meta]), df.select(*[_q(c) for c in feats])
