"""Reshape operators.  Ids: U1-U12 (T1 union is ``unionByName``; T3 ``distinct``).

All are row-local expressions (``unpivot``, ``explode``, array functions) - no shuffle -
except :func:`slot_layout`, which left-joins items onto a per-key slot frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import _q


def unpivot_parsed(df: DataFrame, ids: Sequence[str], cols: Sequence[str], regex: str,
                   var: str = "variable", value: str = "value", parsed: str | None = None,
                   value_type: str | None = None) -> DataFrame:
    """Wide -> long keeping nulls; the variable name is parsed with ``regex`` group 1
    into ``parsed`` (no match -> null).  Values are cast to one type first."""
    src = df
    if value_type:
        src = df.select(*[_q(c) for c in ids], *[F.col(_q(c)).cast(value_type).alias(c) for c in cols])
    long = src.unpivot(list(ids), list(cols), var, value)
    if parsed:
        long = long.withColumn(parsed, F.nullif(F.regexp_extract(var, regex, 1), F.lit("")))
    return long


def unpivot_levels(df: DataFrame, ids: Sequence[str], cols: Sequence[str] | None = None,
                   value: str = "severity", value_type: str = "string") -> DataFrame:
    """Columns named ``<words>_<a>_<b>`` -> (condition, level, value): condition is the
    words capitalised and space-joined (``Spinal Canal Stenosis``), level ``A/B``
    (``L1/L2``)."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in ids]
    long = unpivot_parsed(df, ids, cols, "", "__var", value, value_type=value_type)
    parts = F.split("__var", "_")
    n = F.size(parts)
    cond = F.initcap(F.array_join(F.slice(parts, F.lit(1), n - 2), " "))
    lvl = F.concat(F.initcap(F.element_at(parts, -2)), F.lit("/"), F.initcap(F.element_at(parts, -1)))
    return long.select(*[_q(i) for i in ids], cond.alias("condition"), lvl.alias("level"), _q(value))


def attach_list(df: DataFrame, key: str, item: str, order: str, alias: str = "ranked",
                as_string: bool = True) -> DataFrame:
    """U4: per key the items in ``order`` as an array (or space-joined string).  Meant for
    bounded lists (top-k results)."""
    agg = df.groupBy(_q(key)).agg(F.array_sort(F.collect_list(F.struct(F.col(_q(order)).alias("o"),
                                                                         F.col(_q(item)).alias("v")))).alias("__s"))
    arr = F.transform("__s", lambda s: s["v"])
    if as_string:
        arr = F.array_join(F.transform(arr, lambda x: x.cast("string")), " ")
    return agg.select(_q(key), arr.alias(alias))


def expand_options(df: DataFrame, qid: str, correct: str, options: Mapping[str, str],
                   labels: Mapping[str, str] | None = None, text_parts: Sequence[str] = (),
                   require_label: bool = False) -> DataFrame:
    """One row per option that is **not** the correct one; key ``<qid>_<option>``,
    the option text, the option's label (when ``labels`` given) and ``AllText`` = the
    ``text_parts`` and option text joined by spaces (null-propagating).  With
    ``require_label`` only options with a label are kept (training side)."""
    structs = []
    for opt, col in options.items():
        fields = [F.lit(opt).alias("option"), F.col(_q(col)).cast("string").alias("option_text")]
        if labels:
            fields.append(F.col(_q(labels[opt])).alias("label"))
        structs.append(F.struct(*fields))
    x = df.select("*", F.explode(F.array(*structs)).alias("__o")).filter(F.col("__o.option") != F.col(_q(correct)))
    if require_label and labels:
        x = x.filter(F.col("__o.label").isNotNull())
    from ..functions.text import concat_sep
    out = [F.concat(F.col(_q(qid)).cast("string"), F.lit("_"), F.col("__o.option")).alias(f"{qid}_Answer"),
           F.col(_q(qid)), F.col("__o.option").alias("option"), F.col("__o.option_text").alias("option_text")]
    if labels:
        out.append(F.col("__o.label").alias("label"))
    if text_parts:
        out.append(concat_sep([F.col(_q(c)) for c in text_parts] + [F.col("__o.option_text")], " ").alias("AllText"))
    return x.select(*out)


def replicate(df: DataFrame, n_col: str, shift_cols: Mapping[str, Column], step: float = 1.0,
              alias: str = "copy") -> DataFrame:
    """Each row repeated ``int(n_col)`` times (copy 0..n-1); ``shift_cols`` maps a
    column to the condition under which that column is shifted by ``copy * step``."""
    n = F.col(_q(n_col)).cast("int")
    copies = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))  # none below one
    x = df.select("*", F.explode(copies).alias(alias))
    for c, cond in shift_cols.items():
        x = x.withColumn(c, F.when(cond, F.col(_q(c)) + F.col(alias) * step).otherwise(F.col(_q(c))))
    return x


def to_channel(col, mapping: Mapping[str, int]) -> Column:
    """Description -> channel number; an unknown description raises.  A map lookup
    with ``coalesce(..., raise_error)`` (a ``when`` chain ending in ``raise_error`` does
    not compile in generated code and falls back to interpretation)."""
    c = F.col(_q(col)) if isinstance(col, str) else col
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(int(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c),
                      F.raise_error(F.concat(F.lit("unknown series type: "), c.cast("string"))).cast("int"))


def mirror(df: DataFrame, label: str, block: int = 10, flag: str = "mirrored") -> DataFrame:
    """U8: a second copy of every row with label blocks [0:block] and [block:2*block]
    swapped (left / right), unioned to the original."""
    a = F.col(_q(label))
    swapped = F.concat(F.slice(a, block + 1, block), F.slice(a, 1, block),
                       F.slice(a, 2 * block + 1, F.greatest(F.size(a) - 2 * block, F.lit(0))))
    orig = df.withColumn(flag, F.lit(False))
    return orig.unionByName(df.withColumn(label, swapped).withColumn(flag, F.lit(True)))


def nonzero_cells(df: DataFrame, arr: str, pos: str = "pos", value: str = "v") -> DataFrame:
    """One row per non-zero array cell with its position."""
    return df.select("*", F.posexplode(_q(arr)).alias(pos, value)).drop(arr).filter(F.col(value) != 0)


def columns_to_array(cols: Sequence[str], cast: str | None = "int") -> Column:
    """The listed columns, in order, as one array."""
    return F.array(*[(F.col(_q(c)).cast(cast) if cast else F.col(_q(c))) for c in cols])


def chunk_array(col, size: int) -> Column:
    """Flat array -> array of consecutive chunks of ``size``; the last chunk holds what is
    left, an empty array has no chunk."""
    c = F.col(_q(col)) if isinstance(col, str) else col
    n = F.ceil(F.size(c) / size).cast("int")
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: i < n)
    return F.transform(starts, lambda i: F.slice(c, i * size + 1, size))


def slot_layout(df: DataFrame, key: str, kind: str, ordinal: str, offsets: Mapping[str, int],
                total: int, value: str, empty=0) -> DataFrame:
    """Fixed slots per key: slot = offsets[kind] + ordinal; every key gets all
    ``total`` slots, an unfilled slot holds ``empty``.  A kind's block ends where the next
    begins (or at ``total``); an unknown kind or an ordinal outside its block raises."""
    starts = sorted(offsets.values())
    pairs, ends = [], []
    for k, v in offsets.items():
        pairs += [F.lit(k), F.lit(v)]
        ends += [F.lit(k), F.lit(min([s for s in starts if s > v], default=total))]
    kind_col, ord_col = F.col(_q(kind)), F.col(_q(ordinal))
    off = F.try_element_at(F.create_map(*pairs), kind_col)
    slot = (off + ord_col).cast("int")
    fits = (ord_col >= 0) & (slot < F.try_element_at(F.create_map(*ends), kind_col))
    slot = F.coalesce(F.when(fits, slot), F.raise_error(F.concat(
        F.lit("no slot for "), F.coalesce(kind_col.cast("string"), F.lit("null")), F.lit(" "),
        F.coalesce(ord_col.cast("string"), F.lit("null")))).cast("int"))
    items = df.select(_q(key), slot.alias("slot"), F.col(_q(value)).alias("__v"))
    frame = df.select(_q(key)).distinct().select(_q(key), F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias("slot"))
    return (frame.join(items, [key, "slot"], "left")
            .select(_q(key), "slot", F.coalesce(F.col("__v"), F.lit(empty)).alias(value)))
