"""Schema operators: convention typing, downcast, type / name selection, lenient dates.

Ids: P1, P5, P6, P7, P8, P9, P10, P13, P19, P21.  Every operator builds one ``select``
list from ``df.schema`` (no job); the data-driven ones (P5, P10) run exactly one
aggregate job over all columns at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TypeRules:
    """Naming convention that fixes a column's type.

    Exact names are tested before suffixes, so ``WEEK_NUM`` is not an ``M`` column.
    A suffix mapped to ``None`` leaves the column as read.
    """

    # Fixed values of the convention (exact names, then last letter of the name).
    exact: dict = field(default_factory=lambda: {
        "case_id": "bigint", "WEEK_NUM": "bigint", "num_group1": "bigint",
        "num_group2": "bigint", "date_decision": "date",
    })
    suffix: dict = field(default_factory=lambda: {
        "P": "double", "A": "double", "M": "string", "D": "date", "T": None, "L": None,
    })

    def type_for(self, name: str) -> str | None:
        if name in self.exact:
            return self.exact[name]
        return self.suffix.get(name[-1:]) if name else None


DEFAULT_RULES = TypeRules()


def apply_type_rules(df: DataFrame, rules: TypeRules | None = None) -> DataFrame:
    """Cast every column whose name the rules cover; one projection."""
    rules = rules or DEFAULT_RULES
    cols = []
    for f in df.schema.fields:
        target = rules.type_for(f.name)
        if target is None or f.dataType.simpleString() == target:
            cols.append(F.col(_q(f.name)))
        else:
            cols.append(F.col(_q(f.name)).cast(target).alias(f.name))
    return df.select(*cols)


# Integer ranges of the signed integer types (numpy iinfo limits) and the
# float32 finite range.  The downcast keeps a column in a type only when min and max lie
# strictly inside these limits (open interval).
INT_LIMITS = [
    ("tinyint", -128, 127),
    ("smallint", -32768, 32767),
    ("int", -2147483648, 2147483647),
    ("bigint", -9223372036854775808, 9223372036854775807),
]
FLOAT32_MAX = 3.4028234663852886e38

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def downcast_plan(df: DataFrame) -> DataFrame:
    """P5 report: one row per numeric column with its min, max and chosen type.

    One aggregate job computes min and max of every numeric column; the (tiny) result
    is reshaped with a stack so nothing is looped on the driver.
    """
    num = [f for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL + _FRACTIONAL)]
    if not num:
        return df.sparkSession.createDataFrame([], "column string, kind string, min_value double, max_value double, chosen string")
    aggs = []
    for f in num:
        aggs += [F.min(_q(f.name)).cast("double").alias(f"mn_{len(aggs)}"),
                 F.max(_q(f.name)).cast("double").alias(f"mx_{len(aggs) + 1}")]
    stats = df.agg(*aggs)
    rows = []
    for i, f in enumerate(num):
        kind = "int" if isinstance(f.dataType, _INTEGRAL) else "float"
        rows.append(F.struct(F.lit(f.name).alias("column"), F.lit(kind).alias("kind"),
                             F.col(f"mn_{2 * i}").alias("min_value"),
                             F.col(f"mx_{2 * i + 1}").alias("max_value")))
    long = stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.withColumn("chosen", _chosen_type(F.col("kind"), F.col("min_value"), F.col("max_value"),
                                                  F.lit(None).cast("string")))


def _chosen_type(kind: Column, lo: Column, hi: Column, original: Column) -> Column:
    expr = None
    for name, tmin, tmax in INT_LIMITS:
        cond = (kind == "int") & (lo > F.lit(float(tmin))) & (hi < F.lit(float(tmax)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    cond = (kind == "float") & (lo > F.lit(-FLOAT32_MAX)) & (hi < F.lit(FLOAT32_MAX))
    return expr.when(cond, F.lit("float")).otherwise(original)


def downcast(df: DataFrame) -> DataFrame:
    """P5: cast each numeric column to the narrowest type holding its observed range.

    Runs the one-row min/max job of :func:`downcast_plan` and applies the casts in a
    single projection.  An all-null column keeps its type.
    """
    plan = {r["column"]: r["chosen"] for r in downcast_plan(df).collect()}  # one row per column
    cols = []
    for f in df.schema.fields:
        chosen = plan.get(f.name)
        if chosen and chosen != f.dataType.simpleString():
            cols.append(F.col(_q(f.name)).cast(chosen).alias(f.name))
        else:
            cols.append(F.col(_q(f.name)))
    return df.select(*cols)


def cast_wide_types(df: DataFrame, drop_dates: bool = True) -> DataFrame:
    """Float64 -> Float32, Int64 -> Int32, optionally drop every date column.

    The int cast is a plain (ANSI) cast: a value outside int32 raises, like the
    reference's strict cast.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType) and drop_dates:
            continue
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.col(_q(f.name)).cast("float").alias(f.name))
        elif isinstance(f.dataType, T.LongType):
            cols.append(F.col(_q(f.name)).cast("int").alias(f.name))
        else:
            cols.append(F.col(_q(f.name)))
    return df.select(*cols)


def select_by_type(df: DataFrame, types: Iterable[type], exclude: bool = False) -> DataFrame:
    """Keep (or drop) the columns whose Spark type is one of ``types``."""
    types = tuple(types)
    keep = [f.name for f in df.schema.fields if isinstance(f.dataType, types) != exclude]
    return df.select(*[_q(c) for c in keep])


def columns_of_type(df: DataFrame, types: Iterable[type]) -> list[str]:
    types = tuple(types)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def is_model_column(name: str) -> bool:
    """P7 rule: last character upper case and the rest lower case (Python ``islower``:
    at least one cased character, none upper).  ``x_max`` and ``person_housetype`` fail."""
    return len(name) > 1 and name[-1].isupper() and name[:-1].islower()


def select_by_name(df: DataFrame, predicate: Callable[[str], bool], keep: Iterable[str] = ()) -> DataFrame:
    """Keep the ``keep`` columns plus every column whose name passes ``predicate``."""
    keep = list(keep)
    picked = keep + [c for c in df.columns if c not in keep and predicate(c)]
    return df.select(*[_q(c) for c in picked])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop a fixed list; names that are absent are ignored."""
    return df.drop(*list(cols))


def parse_dates(df: DataFrame, cols: Iterable[str], strict: bool = False, fmt: str | None = None) -> DataFrame:
    """Parse string columns to dates; bad values become null unless ``strict``.

    The lenient path uses ``try_to_date`` / ``try_cast`` (plain ``to_date`` raises under
    ANSI); the strict path raises on the first bad value, like a strict parse.
    """
    cols = set(cols)

    def conv(name: str) -> Column:
        s = F.col(_q(name)).cast("string")
        if strict:
            return (F.to_date(s, fmt) if fmt else s.cast("date")).alias(name)
        if fmt:
            return F.try_to_date(s, F.lit(fmt)).alias(name)
        return F.expr(f"try_cast(cast({_q(name)} as string) as date)").alias(name)

    return df.select(*[conv(c) if c in cols else F.col(_q(c)) for c in df.columns])


def detect_datetime_cols(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """P10 report: for each string column, whether **all** its non-null values parse as dates.

    One aggregate job (``bool_and`` per column); returns ``(column, is_date)`` rows.
    """
    if cols is None:
        cols = columns_of_type(df, [T.StringType])
    cols = list(cols)
    aggs = [F.expr(f"bool_and({_q(c)} is null or try_cast({_q(c)} as date) is not null)").alias(f"c{i}")
            for i, c in enumerate(cols)]
    flags = df.agg(*aggs)
    return flags.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"c{i}"), F.lit(True)).alias("is_date"))
        for i, c in enumerate(cols)])).alias("r")).select("r.*")


def clean_non_finite(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN, +inf and -inf become null in floating columns."""
    targets = set(cols) if cols is not None else set(columns_of_type(df, _FRACTIONAL))
    out = []
    for f in df.schema.fields:
        c = F.col(_q(f.name))
        if f.name in targets:
            out.append(F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
                       .cast(f.dataType).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def align_to(df: DataFrame, columns: Iterable[str], drop: Iterable[str] = ()) -> DataFrame:
    """Take a template's columns (minus ``drop``, e.g. the target) in its order."""
    drop = set(drop)
    return df.select(*[_q(c) for c in columns if c not in drop])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Rename every column to ``prefix + name``."""
    return df.toDF(*[prefix + c for c in df.columns])


def join_null_safe(left, right, keys, how: str = "inner"):
    """Equi join on ``keys`` in which null equals null (rows with a null key keep their statistics); the result has
    the left columns, then the other columns of ``right``."""
    keys = list(keys)
    other = [c for c in right.columns if c not in keys]
    r = right.select(*[F.col(_q(k)).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(_q(c)) for c in other])
    cond = None
    for i, k in enumerate(keys):
        c = F.col(_q(k)).eqNullSafe(F.col(f"__k{i}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__k{i}" for i in range(len(keys))])


def _q(name: str) -> str:
    return f"`{name}`" if not name.startswith("`") else name
