"""Grouped aggregation operators.

Ids: A1-A22, X6.  All grouped operators are one ``groupBy`` (partial + final hash /
sort aggregate, so map-side combining happens before the shuffle).  Where a per-group
statistic must be put back on the rows (A18, A19, A20, A21, A22) the statistic is
aggregated first and joined back on the group key instead of a window over the whole
group: the aggregate combines map-side, and AQE can split a hot key in the join, while a
window would sort an entire hot group inside one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import _q, join_null_safe
from .windows import running_sum_within

# ---------------------------------------------------------------------------
# Suffix-driven aggregation
# ---------------------------------------------------------------------------

# Fixed values of the convention: which name suffix belongs to which column family.
NUM_SUFFIXES = ("P", "A")
DATE_SUFFIXES = ("D",)
STR_SUFFIXES = ("M",)
OTHER_SUFFIXES = ("T", "L")
GROUP_MARKER = "num_group"


def _mean(col: Column, dtype: T.DataType) -> Column:
    """A5: mean; a date mean is fractional days since the epoch (``avg(date)`` is a type
    error in Spark); ``dates_to_offsets`` turns it into whole days later."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.avg(F.unix_date(col.cast("date")))
    return F.avg(col)


# Named aggregate builders (X6): name -> (column, type) -> Column.  ``first``/``last``
# are handled separately (one ``min_by``/``max_by`` over a struct of all their columns).
AGGREGATORS: dict[str, Callable[[Column, T.DataType], Column]] = {
    "max": lambda c, t: F.max(c),
    "min": lambda c, t: F.min(c),
    "mean": _mean,
    "sum": lambda c, t: F.sum(c),
    "count": lambda c, t: F.count(c),
    "mode": lambda c, t: F.mode(c, deterministic=True),
    "n_unique": lambda c, t: F.count_distinct(c),
}
ORDERED = ("first", "last")


@dataclass(frozen=True)
class AggSpec:
    """Configurable aggregator (A2).  Defaults are the reference's preset:
    numbers and dates get max, min, first, last, mean; strings and other columns max,
    min, first, last (+ mode for ``M`` columns); group ordinals max, min, first, last."""

    num_aggs: tuple = ("max", "min", "first", "last", "mean")
    str_aggs: tuple = ("max", "min", "first", "last")
    group_aggs: tuple = ("max", "min", "first", "last")
    str_mode: bool = True
    prefix_sep: str = "_"
    extra: Mapping[str, Callable] = field(default_factory=dict)

    def builder(self, name: str):
        return self.extra.get(name) or AGGREGATORS[name]


MAX_MIN = AggSpec(num_aggs=("max", "min"), str_aggs=("max", "min"), group_aggs=("max", "min"), str_mode=False)


def _families(df: DataFrame, key: Sequence[str]) -> list[tuple[str, list[str]]]:
    cols = [c for c in df.columns if c not in key]
    return [
        ("num", [c for c in cols if c[-1:] in NUM_SUFFIXES]),
        ("date", [c for c in cols if c[-1:] in DATE_SUFFIXES]),
        ("str", [c for c in cols if c[-1:] in STR_SUFFIXES]),
        ("other", [c for c in cols if c[-1:] in OTHER_SUFFIXES]),
        ("group", [c for c in cols if GROUP_MARKER in c]),
    ]


def aggregate(df: DataFrame, key: str | Sequence[str], spec: AggSpec = AggSpec(),
              order_by: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """A2: one grouped aggregate with expressions generated from column-name suffixes.

    Output names are ``<agg>_<col>`` (``prefix`` is put in front of the agg name, used by
    A7).  ``first``/``last`` are the values of the row with the smallest / largest
    ``order_by`` struct, with a null value kept; they are computed as **one**
    ``min_by(struct(values), struct(order))`` and one ``max_by`` for all columns.
    ``order_by`` must be unique within a key; it is required when first/last are used.
    """
    key = [key] if isinstance(key, str) else list(key)
    types = {f.name: f.dataType for f in df.schema.fields}
    plan: list[tuple[str, str, str]] = []  # (out name, agg, column)
    for fam, cols in _families(df, key):
        aggs = {"num": spec.num_aggs, "date": spec.num_aggs, "str": spec.str_aggs,
                "other": spec.str_aggs, "group": spec.group_aggs}[fam]
        for agg in aggs:
            plan += [(f"{prefix}{agg}{spec.prefix_sep}{c}", agg, c) for c in cols]
        if fam == "str" and spec.str_mode:
            plan += [(f"{prefix}mode{spec.prefix_sep}{c}", "mode", c) for c in cols]
    return _run_plan(df, key, plan, types, spec, order_by)


def _run_plan(df, key, plan, types, spec, order_by):
    exprs = []
    firsts = sorted({c for _, a, c in plan if a == "first"}, key=list(df.columns).index)
    lasts = sorted({c for _, a, c in plan if a == "last"}, key=list(df.columns).index)
    if (firsts or lasts) and not order_by:
        raise ValueError("first/last need an order (order_by)")
    if firsts or lasts:
        order = F.struct(*[F.col(_q(c)) for c in order_by])
    if firsts:
        exprs.append(F.min_by(F.struct(*[F.col(_q(c)).alias(f"v{i}") for i, c in enumerate(firsts)]), order)
                     .alias("__first"))
    if lasts:
        exprs.append(F.max_by(F.struct(*[F.col(_q(c)).alias(f"v{i}") for i, c in enumerate(lasts)]), order)
                     .alias("__last"))
    df = _nan_to_null(df, {c for _, a, c in plan if a not in ORDERED})
    modes = [c for _, a, c in plan if a == "mode" and "mode" not in spec.extra]
    simple = [(o, a, c) for o, a, c in plan if a not in ORDERED and not (a == "mode" and c in modes)]
    exprs += [spec.builder(a)(F.col(_q(c)), types[c]).alias(f"__s{i}") for i, (o, a, c) in enumerate(simple)]
    grouped = df.groupBy(*[_q(k) for k in key]).agg(*(exprs or [F.count(F.lit(1)).alias("__rows")]))
    if modes:
        grouped = join_null_safe(grouped, _modes(df, key, modes), key, "left")
    sidx = {o: i for i, (o, a, c) in enumerate(simple)}
    out = [F.col(_q(k)) for k in key]
    for o, a, c in plan:
        if a == "first":
            out.append(F.col("__first").getField(f"v{firsts.index(c)}").alias(o))
        elif a == "last":
            out.append(F.col("__last").getField(f"v{lasts.index(c)}").alias(o))
        elif a == "mode" and c in modes:
            out.append(F.col(f"__mode{modes.index(c)}").cast(types[c]).alias(o))
        else:
            out.append(F.col(f"__s{sidx[o]}").alias(o))
    return grouped.select(*out)


def _nan_to_null(df: DataFrame, cols) -> DataFrame:
    """NaN is a missing value to the aggregates (Spark would take it for the largest number)."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))} & set(cols)
    return df.withColumns({_q(c) if "." in c else c: F.when(~F.isnan(_q(c)), F.col(_q(c))) for c in floats}) \
        if floats else df


def _modes(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A4: ``key, __mode0, ...``: the most frequent non-null value per key, ties to the smallest.

    Two levels: rows are counted per (key, column, value), map-side combined, then one row per
    key takes the best count, so no buffer ever holds a key's value counts."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(_q(c)).cast("string").alias("v"))
                                for i, c in enumerate(cols)])).alias("__c")
    counts = (df.select(*[_q(k) for k in key], cells).filter("__c.v IS NOT NULL")
              .groupBy(*[_q(k) for k in key], "__c").agg(F.count(F.lit(1)).alias("__n")))
    best = [F.min_by("__c.v", F.when(F.col("__c.i") == i, F.struct((-F.col("__n")).alias("n"), F.col("__c.v"))))
            .alias(f"__mode{i}") for i in range(len(cols))]
    return counts.groupBy(*[_q(k) for k in key]).agg(*best)


def agg_by_suffix(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """A1: per key, ``max_<c>`` for every P/A/D/M/T/L and ``num_group*`` column, then
    ``min_<c>`` for the same columns (nulls skipped, strings lexical)."""
    key = [key] if isinstance(key, str) else list(key)
    fams = _families(df, key)
    cols = [c for _, cs in fams for c in cs]
    df = _nan_to_null(df, cols)
    exprs = [F.max(_q(c)).alias(f"max_{c}") for c in cols] + [F.min(_q(c)).alias(f"min_{c}") for c in cols]
    return df.groupBy(*[_q(k) for k in key]).agg(*exprs)


def aggregate_two_stage(df: DataFrame, key: str | Sequence[str], chunk: str, spec: AggSpec,
                        order_by: Sequence[str] | None = None) -> DataFrame:
    """The chunk-then-final aggregation of the reference, in one shuffle.

    The reference aggregates each file chunk, concatenates, and aggregates again,
    prefixing twice (``max_max_c``, ``first_first_c``).  For max, min, first and last this
    equals one aggregate whose first/last order starts with the chunk number, so Spark's
    own partial/final aggregate does the work; only the names are kept.  Mean and mode
    are refused (a mean of means is not the mean).
    """
    bad = {"mean", "mode"} & (set(spec.num_aggs) | set(spec.str_aggs) | set(spec.group_aggs) |
                              ({"mode"} if spec.str_mode else set()))
    if bad:
        raise ValueError(f"two-stage aggregation is only valid for max/min/first/last, not {sorted(bad)}")
    key = [key] if isinstance(key, str) else list(key)
    types = {f.name: f.dataType for f in df.schema.fields}
    plan = []
    for fam, cols in _families(df.drop(chunk), key):
        aggs = {"num": spec.num_aggs, "date": spec.num_aggs, "str": spec.str_aggs,
                "other": spec.str_aggs, "group": spec.group_aggs}[fam]
        for agg in aggs:
            plan += [(f"{agg}_{agg}_{c}", agg, c) for c in cols]
    order = [chunk] + list(order_by or [])
    return _run_plan(df, key, plan, types, spec, order)


def any_match(cond: Column, alias: str) -> Column:
    """True if any row matches, false if none, null if all inputs are null."""
    return F.max(cond).alias(alias)


# ---------------------------------------------------------------------------
# Reports and checks
# ---------------------------------------------------------------------------


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Count per value, descending (ties by value)."""
    return df.groupBy(_q(col)).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.col(_q(col)))


def mean_by(df: DataFrame, t: str, y: str, z: float = 1.96) -> DataFrame:
    """Mean of ``y`` per ``t`` with count, sample stddev and the normal-approximation
    band ``mean +- z * std / sqrt(n)``."""
    g = df.groupBy(_q(t)).agg(F.avg(_q(y)).alias("mean"), F.count(_q(y)).alias("n"),
                              F.stddev_samp(_q(y)).alias("std"))
    half = F.lit(z) * F.col("std") / F.sqrt(F.col("n"))
    return g.select(_q(t), "mean", "n", "std", (F.col("mean") - half).alias("lower"),
                    (F.col("mean") + half).alias("upper"))


def exact_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float], by: Sequence[str] = (),
                    prefix: str = "__q") -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default) per ``by`` group:
    ``(by..., <prefix>0, <prefix>1, ...)``.

    Spark's exact ``percentile`` merges a count map of every distinct value into one
    buffer per group (one task for a global or hot group).  Here rows are first counted per
    (group, value), map-side combined, so a value held by a third of the rows is one row;
    running sums of the counts (:func:`running_sum_within`) give the ranks each value covers,
    and the values at ``floor`` / ``ceil`` of ``p * (n - 1)`` are interpolated."""
    by = list(by)
    v = (F.col(_q(value)) if isinstance(value, str) else value).cast("double")
    x = df.select(*[F.col(_q(b)) for b in by], v.alias("__v")).filter(F.col("__v").isNotNull())
    counts = x.groupBy(*[_q(b) for b in by], "__v").agg(F.count(F.lit(1)).alias("__c"))
    r = running_sum_within(counts, by, "__v", "__c", "__below")
    total = r.groupBy(*[_q(b) for b in by]).agg(F.sum("__c").alias("__n"))
    r = _attach(r, total, by)
    aggs = []
    for i, p in enumerate(probs):
        q = F.lit(float(p)) * (F.col("__n") - 1)
        for name, at in (("lo", F.floor(q)), ("hi", F.ceil(q))):
            held = (F.col("__below") <= at) & (at < F.col("__below") + F.col("__c"))
            aggs.append(F.max(F.when(held, F.col("__v"))).alias(f"__{name}{i}"))
        aggs.append(F.max(q - F.floor(q)).alias(f"__f{i}"))
    g = r.groupBy(*[_q(b) for b in by]).agg(*aggs)
    return g.select(*[_q(b) for b in by], *[
        (F.col(f"__lo{i}") + F.col(f"__f{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))).alias(f"{prefix}{i}")
        for i in range(len(probs))])


def narrowed_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], room: int = 1 << 18,
                       rounds: int = 5) -> dict[str, list[float | None]]:
    """Exact quantiles (numpy's linear interpolation) of many columns at once: ``{column: [one per prob]}``.

    Every wanted rank of every column lies in a known interval.  One pass over the table cuts all open intervals into
    cells and counts them together (map-side combined, ``room`` cells in all); each rank goes on with the least and
    greatest value of its cell, and is found when they are equal.  The first pass gives counts and extremes.  Most data
    need two or three passes; values so unevenly spaced that ``rounds`` do not end are finished by
    :func:`exact_quantiles` within the interval.  The driver sees at most ``room`` counts a pass.  NaN counts as the largest
    value, nulls are left out; a column without values has None."""
    v = {c: F.col(_q(c)).cast("double") for c in cols}
    finite = {c: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x) for c, x in v.items()}
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(v[c]).alias(f"n{i}"), F.count(finite[c]).alias(f"f{i}"), F.min(finite[c]).alias(f"a{i}"),
                 F.max(finite[c]).alias(f"b{i}"), F.count_if(v[c] == float("-inf")).alias(f"l{i}"), F.count_if(F.isnan(v[c])).alias(f"x{i}")]
    if not cols:
        return {}
    first = df.agg(*aggs).first()
    found: dict[tuple[int, int], float] = {}
    todo: dict[tuple[int, int], tuple[float, float, int]] = {}  # (column, rank) -> interval, values below it
    for i in range(len(cols)):
        n, low, nan = first[f"n{i}"], first[f"l{i}"], first[f"x{i}"]
        for p in probs:
            for rank in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))} if n else ():
                if rank < low:
                    found[i, rank] = float("-inf")
                elif rank >= low + first[f"f{i}"]:
                    found[i, rank] = float("nan") if rank >= n - nan else float("inf")
                else:
                    todo[i, rank] = (first[f"a{i}"], first[f"b{i}"], low)
    for _ in range(rounds):
        for key in [k for k, (a, b, _) in todo.items() if a == b]:
            found[key] = todo.pop(key)[0]
        if not todo:
            break
        spans = sorted({(i, a, b) for (i, _), (a, b, _) in todo.items()})
        n_cells = max(2, room // len(spans))
        parts = []
        for s, (i, a, b) in enumerate(spans):
            x = finite[cols[i]]
            at = F.floor((x * 0.5 - a * 0.5) / (b * 0.5 - a * 0.5) * n_cells)
            cell = F.least(F.greatest(at, F.lit(0)), F.lit(n_cells - 1)).cast("int")
            parts.append(F.when((x >= a) & (x <= b), F.struct(F.lit(s).alias("s"), cell.alias("c"), x.alias("v"))))
        got = (df.select(F.explode(F.array_compact(F.array(*parts))).alias("p")).groupBy("p.s", "p.c")
               .agg(F.count(F.lit(1)).alias("n"), F.min("p.v").alias("lo"), F.max("p.v").alias("hi")).toPandas().sort_values(["s", "c"]))
        number = {span: s for s, span in enumerate(spans)}
        per = {s: g for s, g in got.groupby("s")}
        for (i, rank), (a, b, below) in list(todo.items()):
            g = per[number[i, a, b]]
            ends = below + g["n"].cumsum().to_numpy()
            at = int((ends <= rank).sum())
            todo[i, rank] = (float(g["lo"].iloc[at]), float(g["hi"].iloc[at]), int(ends[at] - g["n"].iloc[at]))
    for (i, rank), (a, b, below) in todo.items():
        inside = df.select(finite[cols[i]].alias("v")).filter((F.col("v") >= a) & (F.col("v") <= b))
        n = inside.count()
        found[i, rank] = a if n == 1 else exact_quantiles(inside, "v", [(rank - below) / (n - 1)]).first()[0]
    out = {}
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        out[c] = []
        for p in probs:
            q = p * (n - 1)
            lo, hi = (found[i, math.floor(q)], found[i, math.ceil(q)]) if n else (None, None)
            out[c].append(lo + (q - math.floor(q)) * (hi - lo) if n else None)
    return out


def profile(df: DataFrame, cols: Iterable[str] | None = None, approx: bool = False) -> DataFrame:
    """Describe + info in long form: one row per column with type, non-null count,
    mean, sample std, min, quartiles (linear interpolation) and max.

    Counts, moments and extremes are one aggregate.  Quartiles are exact, of all columns in the same few passes
    (:func:`narrowed_quantiles`); ``approx=True`` uses the bounded ``percentile_approx`` in the aggregate instead.
    """
    fields = [f for f in df.schema.fields if (cols is None or f.name in set(cols))]
    numeric = {f.name for f in fields if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.DecimalType)}
    exact = {} if approx else narrowed_quantiles(df, [f.name for f in fields if f.name in numeric], [0.25, 0.5, 0.75])
    aggs, rows = [], []
    nul = F.lit(None).cast("double")
    for i, f in enumerate(fields):
        c = F.col(_q(f.name))
        aggs.append(F.count(c).alias(f"n{i}"))
        d = c.cast("double") if f.name in numeric else nul
        q = [nul] * 3
        if f.name in numeric:
            aggs += [F.avg(d).alias(f"m{i}"), F.stddev_samp(d).alias(f"s{i}"), F.min(d).alias(f"lo{i}"),
                     F.max(d).alias(f"hi{i}")]
            if approx:
                aggs.append(F.percentile_approx(d, [0.25, 0.5, 0.75], 10000).alias(f"q{i}"))
            q = [F.col(f"q{i}")[j] if approx else F.lit(exact[f.name][j]).cast("double") for j in range(3)]
        stat = lambda name, i=i, f=f: F.col(f"{name}{i}") if f.name in numeric else nul
        rows.append(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                             F.col(f"n{i}").alias("non_null"), stat("m").alias("mean"), stat("s").alias("std"),
                             stat("lo").alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"),
                             stat("hi").alias("max")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def collect_per(df: DataFrame, key: str, col: str, alias: str | None = None) -> DataFrame:
    """Sorted distinct values of ``col`` per key (e.g. study -> its series).

    Meant for bounded groups (a study has a handful of series); the list is the result.
    """
    return df.groupBy(_q(key)).agg(F.sort_array(F.collect_set(_q(col))).alias(alias or f"{col}_list"))


def map_per(df: DataFrame, key: str, k: str, v: str, alias: str = "mapping") -> DataFrame:
    """``key -> map(k -> v)``; a ``k`` with two values raises ``DUPLICATED_MAP_KEY``."""
    return df.groupBy(_q(key)).agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(_q(k), _q(v)))))
                                   .alias(alias))


def label_vector(df: DataFrame, key: str, order: Sequence[str], value: str, alias: str = "labels") -> DataFrame:
    """Per key, the distinct ``(order..., value)`` rows sorted by ``order`` -> array of
    values (25 per study in the reference)."""
    st = F.struct(*[F.col(_q(c)) for c in order], F.col(_q(value)).alias("__v"))
    return df.groupBy(_q(key)).agg(F.transform(F.array_sort(F.collect_set(st)), lambda x: x["__v"]).alias(alias))


def assert_constant(df: DataFrame, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Groups where any of ``cols`` takes more than one distinct value (report of
    violations; empty when the data is consistent)."""
    key = [key] if isinstance(key, str) else list(key)
    g = df.groupBy(*[_q(k) for k in key]).agg(*[F.count_distinct(_q(c)).alias(f"n_{c}") for c in cols])
    bad = None
    for c in cols:
        cond = F.col(f"n_{c}") > 1
        bad = cond if bad is None else (bad | cond)
    return g.filter(bad)


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    key = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*[_q(k) for k in key]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``has_null_<c>`` and ``n_null_<c>`` per column."""
    aggs = []
    for c in cols:
        aggs += [F.bool_or(F.col(_q(c)).isNull()).alias(f"has_null_{c}"),
                 F.sum(F.col(_q(c)).isNull().cast("long")).alias(f"n_null_{c}")]
    return df.agg(*aggs)


# ---------------------------------------------------------------------------
# Per-group scaling, voxels, completeness, stacks
# ---------------------------------------------------------------------------


def _by(by) -> list[str]:
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


def _attach(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    if not by:
        # one-row statistic table: attached as one struct-valued scalar subquery
        st = stats.select(F.struct(*[F.col(_q(c)) for c in stats.columns])).scalar()
        return df.select("*", *[st.getField(c).alias(c) for c in stats.columns])
    return join_null_safe(df, stats, by)


def clip_scale(df: DataFrame, value: str, by=None, lower: float = 0.1, upper: float = 99.9,
               alias: str = "scaled", approx: bool = False) -> DataFrame:
    """Clip to the ``lower``/``upper`` percentiles (linear interpolation), shift so
    the minimum is 0, divide by the maximum, x255, truncate to 0..255.  A constant group
    gives 0.  The per-group percentiles (exact: :func:`exact_quantiles`; or bounded
    ``percentile_approx``) are joined back on the group."""
    by = _by(by)
    v = F.col(_q(value)).cast("double")
    if approx:
        q = F.percentile_approx(v, [lower / 100, upper / 100], 100000)
        stats = (df.groupBy(*[_q(b) for b in by]).agg(q.alias("__q"))
                 .select(*[_q(b) for b in by], F.col("__q")[0].alias("__lo"), F.col("__q")[1].alias("__hi")))
    elif not by:
        lo, hi = narrowed_quantiles(df, [value], [lower / 100, upper / 100])[value]
        stats = None
        j = df.withColumns({"__lo": F.lit(lo).cast("double"), "__hi": F.lit(hi).cast("double")})
    else:
        stats = exact_quantiles(df, value, [lower / 100, upper / 100], by, prefix="__p").select(
            *[_q(b) for b in by], F.col("__p0").alias("__lo"), F.col("__p1").alias("__hi"))
    j = _attach(df, stats, by) if stats is not None else j
    clipped = F.least(F.greatest(v, F.col("__lo")), F.col("__hi"))
    span = F.col("__hi") - F.col("__lo")
    scaled = F.when(span > 0, ((clipped - F.col("__lo")) / span * 255).cast("int")).otherwise(F.lit(0))
    return j.withColumn(alias, scaled).drop("__lo", "__hi")


def minmax_scale(df: DataFrame, value: str, by=None, alias: str = "scaled", eps: float = 1e-6) -> DataFrame:
    """``(x - min) / (max - min + eps) * 255`` per group."""
    by = _by(by)
    stats = df.groupBy(*[_q(b) for b in by]).agg(F.min(_q(value)).alias("__mn"), F.max(_q(value)).alias("__mx"))
    j = _attach(df, stats, by)
    v = F.col(_q(value)).cast("double")
    return (j.withColumn(alias, (v - F.col("__mn")) / (F.col("__mx") - F.col("__mn") + F.lit(eps)) * 255)
            .drop("__mn", "__mx"))


def voxelize(points: DataFrame, key: str, n: int, xyz=("x", "y", "z"), channel: str = "ch",
             value: str = "val") -> DataFrame:
    """Point cloud -> sparse voxel grid (long form).

    Per key the axis-aligned bounding box; each point is scaled to ``0..n-1`` by
    ``(p - min) * (n - 1) / (max - min)`` (an axis with ``max == min`` maps to 0), rounded
    half to even; per (key, voxel, channel) the maximum value, with the grid's zero floor.
    The final group is (key, ix, iy, iz, channel), so one large study spreads over many
    tasks.  Empty cells (value 0) are not emitted.
    """
    x, y, z = xyz
    box = points.groupBy(_q(key)).agg(*[f(_q(c)).alias(f"__{f.__name__}_{c}") for c in xyz for f in (F.min, F.max)])
    j = join_null_safe(points, box, [key])

    def idx(c: str) -> Column:
        lo, hi = F.col(f"__min_{c}"), F.col(f"__max_{c}")
        scaled = (F.col(_q(c)) - lo) * F.lit(float(n - 1)) / (hi - lo)
        return F.when(hi > lo, F.bround(scaled, 0)).otherwise(F.lit(0.0)).cast("int")

    cells = j.select(_q(key), idx(x).alias("ix"), idx(y).alias("iy"), idx(z).alias("iz"), _q(channel),
                     F.col(_q(value)).cast("double").alias("__v"))
    return (cells.groupBy(_q(key), "ix", "iy", "iz", _q(channel))
            .agg(F.greatest(F.max("__v"), F.lit(0.0)).alias("value"))
            .filter(F.col("value") > 0))


def complete_groups(df: DataFrame, key: str, sub: str, expected: Mapping[str, int] | Column,
                    total: int | None = None, default: int | None = None) -> DataFrame:
    """A21 (+W1): keep the rows of keys whose every ``sub`` group has exactly the expected
    row count (``expected[sub]``, or ``default``) and, if given, ``total`` rows overall.

    Counts are one aggregate per (key, sub) and per key; the passing keys are joined back
    with a left-semi join (no window over a whole key)."""
    if isinstance(expected, Column):
        exp_col = expected
    else:
        pairs = []
        for k, v in expected.items():
            pairs += [F.lit(k), F.lit(v)]
        exp_col = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(_q(sub))),
                             F.lit(default).cast("int"))
    per_sub = df.groupBy(_q(key), _q(sub)).agg(F.count(F.lit(1)).alias("__n"))
    per_key = (per_sub.groupBy(_q(key))
               .agg(F.bool_and(F.col("__n") == exp_col).alias("__ok"), F.sum("__n").alias("__tot")))
    good = per_key.filter(F.col("__ok") & (F.lit(True) if total is None else (F.col("__tot") == total)))
    return join_null_safe(df, good.select(_q(key)), [key], "left_semi")


def split_stacks(df: DataFrame, series: str | Sequence[str], orientation: str, alias: str = "stack") -> DataFrame:
    """Rows of a series grouped by identical orientation; each group is one stack,
    numbered from 0 in orientation order.  Ranked on the distinct (series, orientation)
    table, then joined back."""
    series = _by(series)
    from pyspark.sql.window import Window
    d = df.select(*[_q(s) for s in series], _q(orientation)).distinct()
    w = Window.partitionBy(*[_q(s) for s in series]).orderBy(_q(orientation))
    ranked = d.withColumn(alias, F.dense_rank().over(w) - 1)
    return join_null_safe(df, ranked, series + [orientation])
