"""Join operators.  Ids: J1-J10.

Join strategy is left to Catalyst + AQE (sort-merge by default, broadcast when the
runtime size of a side is below ``spark.sql.autoBroadcastJoinThreshold``).  No side is
broadcast by hint here.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stabbing import PointTree, stab
from ..session import ensure_checkpoint_dir, materialised
from .schema import _q, join_null_safe


def left_join_suffixed(left: DataFrame, right: DataFrame, on: str | Sequence[str], suffix: str) -> DataFrame:
    """Left join keeping all left rows; right-side names that collide with a left
    name get ``suffix`` (like a ``_{i}`` join suffix), once more for as long as either side has the suffixed name."""
    on = [on] if isinstance(on, str) else list(on)
    taken = set(left.columns)
    ren = {}
    used = taken | set(right.columns)
    for c in right.columns:
        if c not in on and c in taken:
            name = f"{c}{suffix}"
            while name in used:
                name += suffix
            used.add(name)
            ren[c] = name
    r = right.withColumnsRenamed(ren) if ren else right
    return left.join(r, on=on, how="left")


def join_all(base: DataFrame, tables: Iterable[DataFrame], on: str | Sequence[str] = "case_id",
             suffix_fmt: str = "_{i}") -> DataFrame:
    """Chain of left joins onto ``base``; the i-th table's colliding names get
    ``suffix_fmt.format(i=i)``.  All children are grouped by the join key, so their hash
    partitioning on the key is reused across the chain."""
    out = base
    for i, t in enumerate(tables):
        out = left_join_suffixed(out, t, on, suffix_fmt.format(i=i))
    return out


def bucketed(df: DataFrame, on: str | Sequence[str], buckets: int | None = None, name: str = "bucketed") -> DataFrame:
    """``df`` written once, bucketed by the join key, and read back as a table.

    Rows are shuffled here for the last time: tables of the same key and number of ``buckets`` (default: the shuffle
    partitions) are then joined and grouped by the key without an exchange, as often as wanted, so a child is written once
    and serves every chain.  A bucket is one file.  The rows of one key share a bucket, so this is for keys with few rows
    each, as the chain's tables have after aggregation.  The files lie in the shared checkpoint folder."""
    spark = df.sparkSession
    on = [on] if isinstance(on, str) else list(on)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    (df.repartition(n, *[_q(c) for c in on]).write.format("parquet").bucketBy(n, *on).sortBy(*on).option("path", path)
     .saveAsTable(table))
    return spark.table(table)


def assign_by_key(template: DataFrame, scores: DataFrame, key: str | Sequence[str],
                  cols: Sequence[str] | None = None) -> DataFrame:
    """Put ``scores`` columns on the template rows; missing keys stay null."""
    key = [key] if isinstance(key, str) else list(key)
    cols = list(cols) if cols is not None else [c for c in scores.columns if c not in key]
    t = template.drop(*[c for c in cols if c in template.columns])
    return t.join(scores.select(*[_q(c) for c in key + cols]), on=key, how="left")


def semi(df: DataFrame, ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``ids``."""
    return df.join(ids, on=key, how="left_semi")


def anti(df: DataFrame, ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``ids``."""
    return df.join(ids, on=key, how="left_anti")


def distinct_value_pairs(df: DataFrame, col: str) -> DataFrame:
    """J7 (+T3), re-aimed: the reference lists every ordered pair ``a <= b`` of the
    distinct values.  Emitting all pairs is quadratic, so the pair set is returned in its
    compact, equivalent form: one row per distinct value ``a`` with its 0-based rank and
    ``n_partners`` = the number of distinct values ``b >= a`` (the pairs starting at ``a``
    are exactly the values of rank >= rank(a)).  Ranks come from the distinct set only.
    """
    from .windows import rank_within
    d = df.select(F.col(_q(col)).alias("a")).distinct()
    r = rank_within(d, None, ["a"], alias="rank", count_alias="__n")
    return r.select("a", "rank", (F.col("__n") - F.col("rank")).alias("n_partners"))


def match_points(points: DataFrame, volumes: DataFrame, study: str = "study_id",
                 series: str | None = "series_id") -> DataFrame:
    """Each point x each volume of its study; with ``series`` also the series must
    agree.  The study (and series) equality is the join key, so the nested loop is only
    within a study; the unconditional form projects a point to all volumes of its study."""
    keys = [study] + ([series] if series else [])
    return points.join(volumes, on=keys, how="inner")


def points_in_boxes(points: DataFrame, boxes: DataFrame, study: str, xyz: Sequence[str], lo: Sequence[str],
                    hi: Sequence[str]) -> DataFrame:
    """J8 (bounded form): every pair of a point and a box of its study that holds it, bounds included; columns of the
    point, then the other columns of the box.

    A spatial cell join.  Cells of level n have edges of 2^n; a box lies on the level whose edge is its longest side or
    the next above, so it touches at most two cells an axis, eight in three dimensions.  A point lies in one cell of each
    level that some box uses.  Points and boxes meet by (study, level, cell) and the exact bounds decide, so a study is
    never gathered: a hot one is spread over its cells.  Points and boxes with a null or NaN coordinate or a null study
    are in no pair; a box with ``hi < lo`` holds nothing."""
    d = range(len(xyz))
    edge = F.greatest(*[F.col(_q(hi[i])).cast("double") - F.col(_q(lo[i])).cast("double") for i in d])
    level = F.when(edge > 0, F.greatest(F.ceil(F.log2(edge)).cast("int"), F.lit(-60))).otherwise(F.lit(-60))
    whole = None
    for i in d:
        a, b = F.col(_q(lo[i])).cast("double"), F.col(_q(hi[i])).cast("double")
        ok = (a <= b) & ~F.isnan(b) & (F.abs(a) < 1e300) & (F.abs(b) < 1e300)
        whole = ok if whole is None else whole & ok
    cell = lambda c, lev: F.floor(c.cast("double") / F.pow(F.lit(2.0), lev)).cast("double")
    cells = boxes.filter(whole).withColumn("__level", level)
    levels = cells.select(F.array_sort(F.collect_set("__level"))).scalar()  # at most one per power of two
    for i in d:
        a, b = cell(F.col(_q(lo[i])), F.col("__level")), cell(F.col(_q(hi[i])), F.col("__level"))
        cells = cells.withColumn(f"__c{i}", F.explode(F.when(a == b, F.array(a)).otherwise(F.array(a, b))))
    keep = [c for c in boxes.columns if c != study]
    cells = cells.select(F.col(_q(study)).alias("__study"), "__level", *[f"__c{i}" for i in d], *[F.col(_q(c)) for c in keep])
    at = points.withColumn("__level", F.explode(levels))
    for i in d:
        at = at.withColumn(f"__p{i}", cell(F.col(_q(xyz[i])), F.col("__level")))
    on = (F.col(_q(study)) == F.col("__study")) & (at["__level"] == cells["__level"])
    for i in d:
        on &= F.col(f"__p{i}") == F.col(f"__c{i}")
        on &= (F.col(_q(xyz[i])) >= F.col(_q(lo[i]))) & (F.col(_q(xyz[i])) <= F.col(_q(hi[i])))
    return at.join(cells, on).select(*[F.col(_q(c)) for c in points.columns], *[F.col(_q(c)) for c in keep])


def box_hits(points: DataFrame, boxes: DataFrame, key: Sequence[str], study: str, xyz: Sequence[str], lo: Sequence[str],
             hi: Sequence[str], box_id: str, point_rows: int = 1 << 17, box_rows: int = 1 << 19) -> DataFrame:
    """Rows of ``key``, ``__n`` and ``__first`` whose sums and minima per key are the number of boxes of its study that
    hold a point and the smallest ``box_id`` among them; points without a box have no row.

    A distributed k-d tree.  Splits from a bounded sample of the points (they only balance the blocks) deal all points to
    blocks of about ``point_rows`` neighbours; the study takes part as two hashed axes (106 bits).  A box that holds all
    points of a node is added up at the node, else it goes to the few blocks that it cuts, where :func:`stab` counts it in
    a task of its own.  The points and boxes of a crowded block are dealt over more tasks; counts add up.  The driver sees
    the splits and one row per block."""
    spark, d = points.sparkSession, len(xyz)
    num = lambda c: F.col(_q(c)).cast("double")
    of = [F.shiftrightunsigned(F.xxhash64(F.lit(i), F.col(_q(study))), 11).cast("double") for i in (1, 2)]
    held = F.col(_q(study)).isNotNull()
    for c in xyz:
        held &= num(c).isNotNull() & ~F.isnan(num(c))
    axes = [f"__a{i}" for i in range(d + 2)]
    lows, highs = [f"__l{i}" for i in range(d + 2)], [f"__h{i}" for i in range(d + 2)]
    p = points.filter(held).select(*map(_q, key), *[c.alias(a) for c, a in zip([*of, *map(num, xyz)], axes)])
    held = F.col(_q(study)).isNotNull()
    for a, b in zip(lo, hi):
        held &= (num(a) <= num(b)) & ~F.isnan(num(b)) & (F.abs(num(a)) < 1e300) & (F.abs(num(b)) < 1e300)
    b = boxes.filter(held).select(F.col(_q(box_id)).alias("__box"), *[c.alias(a) for c, a in zip([*of, *map(num, lo)], lows)],
                                  *[c.alias(a) for c, a in zip([*of, *map(num, hi)], highs)])
    sides = np.array([x or 0.0 for x in b.agg(*[F.avg(F.col(h) - F.col(a)) for a, h in zip(lows, highs)]).first()])
    rows = p.count()
    blocks = max(1, -(-rows // point_rows))
    some = np.zeros((0, d + 2))
    if blocks > 1:
        wanted = min(64 * blocks, 1 << 18)
        some = p.select(*axes).sample(min(1.0, wanted / rows), seed=7).limit(2 * wanted).toPandas().to_numpy(np.float64)
    tree = PointTree(some, sides, max(1, -(-len(some) // blocks)))
    tree.order = None  # the tasks need the splits only

    def place(batches):
        for batch in batches:
            at = tree.leaf_of(_columns(batch, axes))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], [*batch.schema.names, "__block"])

    placed = materialised(p.mapInArrow(place, T.StructType([*p.schema.fields, T.StructField("__block", T.LongType())])), "placed")
    bounds = placed.groupBy("__block").agg(F.count(F.lit(1)).alias("n"), *[F.min(a) for a in axes], *[F.max(a) for a in axes]).collect()
    tree.set_bounds([r[0] for r in bounds], np.array([r[2:d + 4] for r in bounds], np.float64).reshape(-1, d + 2),
                    np.array([r[d + 4:] for r in bounds], np.float64).reshape(-1, d + 2))

    def met(want_whole, fields):
        def run(batches):
            for batch in batches:
                for box, node, whole in tree.meet(_columns(batch, lows), _columns(batch, highs)):
                    chosen = whole == want_whole
                    if chosen.any():
                        out = batch.take(pa.array(box[chosen])).select(fields)
                        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(node[chosen], pa.int64())], [*fields, "__block"])
        schema = T.StructType([*[b.schema[f] for f in fields], T.StructField("__block", T.LongType())])
        return b.mapInArrow(run, schema)

    whole = met(True, ["__box"]).groupBy("__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__box").alias("__first"))
    parent = {int(c): i for i in range(len(tree.axis)) for c in (tree.left[i], tree.right[i]) if c >= 0}
    above = []
    for r in bounds:
        node = r[0]
        while node is not None:
            above.append((r[0], node))
            node = parent.get(node)
    above = spark.createDataFrame(above, "__leaf bigint, __block bigint")
    whole = (above.join(whole, "__block").groupBy(F.col("__leaf").alias("__block"))
             .agg(F.sum("__n").alias("__n"), F.min("__first").alias("__first")))
    cut = materialised(met(False, ["__box", *lows, *highs]), "cut")
    crowd = dict(cut.groupBy("__block").count().collect())  # one row per block
    tasks = spark.createDataFrame([(r[0], -(-r["n"] // point_rows), -(-crowd[r[0]] // box_rows)) for r in bounds if r[0] in crowd],
                                  "__block bigint, __ps bigint, __bs bigint")
    deal = lambda cols, n: F.pmod(F.xxhash64(*cols), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = placed.join(tasks, "__block").select("__block", deal([F.col(_q(k)) for k in key], "__ps").alias("__p"), every("__bs").alias("__b"), *map(_q, key), *axes)
    right = cut.join(tasks, "__block").select("__block", every("__ps").alias("__p"), deal([F.col(c) for c in ["__box", *lows]], "__bs").alias("__b"),
                                              "__box", *lows, *highs)

    def count(ps: pa.Table, bs: pa.Table) -> pa.Table:
        ids = bs.column("__box").combine_chunks()
        by_id = pc.sort_indices(ids).to_numpy()  # nulls last
        rank = np.empty(len(ids), np.int64)
        rank[by_id] = np.arange(len(ids))
        hits, best = stab(_columns(ps, axes), _columns(bs, lows), _columns(bs, highs), rank)
        found = np.flatnonzero(hits)
        first = ids.take(pa.array(by_id[best[found]]))
        return pa.table([*ps.select(list(key)).take(pa.array(found)).columns, pa.array(hits[found], pa.int64()), first],
                        [*key, "__n", "__first"])

    schema = T.StructType([*[p.schema[k] for k in key], T.StructField("__n", T.LongType()),
                           T.StructField("__first", b.schema["__box"].dataType)])
    on = ["__block", "__p", "__b"]
    counted = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(count, schema)
    return counted.unionByName(placed.join(whole, "__block").select(*map(_q, key), "__n", "__first"))


def _columns(table, names: Sequence[str]) -> np.ndarray:
    return np.stack([table.column(n).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(n).to_numpy()
                     for n in names], 1).astype(np.float64)


def box_counts(points: DataFrame, boxes: DataFrame, key: Sequence[str], study: str, xyz: Sequence[str], lo: Sequence[str],
               hi: Sequence[str], box_id: str) -> DataFrame:
    """Per point (``key``, unique) the number of boxes of its study that hold it, the smallest ``box_id`` among them,
    and the number that it misses.  A point without a box has zeros; a study without boxes too.  Coordinates compare as
    doubles.  The pairs, whose number grows with points times boxes, are counted and never listed: :func:`box_hits`."""
    inside = (box_hits(points, boxes, key, study, xyz, lo, hi, box_id)
              .groupBy(*map(_q, key)).agg(F.sum("__n").alias("n_inside"), F.min("__first").alias("first_box")))
    total = boxes.filter(F.col(_q(study)).isNotNull()).groupBy(_q(study)).agg(F.count(F.lit(1)).alias("__boxes"))
    out = join_null_safe(join_null_safe(points, inside, key, "left"), total, [study], "left")
    n = F.coalesce("n_inside", F.lit(0).cast("bigint"))
    return out.select(*map(_q, key), n.alias("n_inside"), "first_box", (F.coalesce("__boxes", F.lit(0).cast("bigint")) - n).alias("n_missed"))


def lookup_or(df: DataFrame, table: DataFrame, keys: Sequence[str], value: str,
              fallback_keys: dict | None = None, default=None, alias: str | None = None) -> DataFrame:
    """Dictionary look-up with fallback.

    ``value`` of the row of ``table`` matching ``keys``; when absent, the row matching
    ``fallback_keys`` (same keys with some replaced by constants, e.g. serial 1); then
    ``default``.  Both look-ups are left joins.  A key that the dictionary holds several
    times takes its smallest value, so rows are never multiplied."""
    alias = alias or value
    table = table.groupBy(*[_q(k) for k in keys]).agg(F.min(_q(value)).alias(value))
    hit = table.select(*[_q(k) for k in keys], F.col(_q(value)).alias("__hit"))
    out = df.join(hit, on=list(keys), how="left")
    result = F.col("__hit")
    if fallback_keys:
        fixed = {k: v for k, v in fallback_keys.items()}
        free = [k for k in keys if k not in fixed]
        cond = None
        for k, v in fixed.items():
            c = F.col(_q(k)) == F.lit(v)
            cond = c if cond is None else (cond & c)
        fb = table.filter(cond).select(*[_q(k) for k in free], F.col(_q(value)).alias("__fb"))
        out = out.join(fb, on=free, how="left")
        result = F.coalesce(result, F.col("__fb"))
    if default is not None:
        result = F.coalesce(result, F.lit(default))
    return out.withColumn(alias, result).drop("__hit", "__fb")


def missing_combos(df: DataFrame, a: str, b: str) -> DataFrame:
    """Every (a, b) pair of the distinct values that has no row in ``df``.

    The distinct pairs present are anti-joined from the frame of distinct values; the frame
    is built per ``a`` from a generator over the ranks of the ``b`` values, whose values are
    then looked up by rank, so no buffer holds all of ``b`` and no product join is planned."""
    from .windows import rank_within
    values = rank_within(df.select(F.col(_q(b)).alias("__b")).filter("__b IS NOT NULL").distinct(), None, ["__b"],
                         alias="__rb")
    n = values.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    frame = (df.select(_q(a)).distinct().filter(n > 0)
             .select(_q(a), F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(n - 1, F.lit(0)))).alias("__rb"))
             .join(values, "__rb").select(_q(a), F.col("__b").alias(b)))
    seen = df.select(F.col(_q(a)).alias("__a"), F.col(_q(b)).alias("__b")).distinct()
    return frame.join(seen, F.col(_q(a)).eqNullSafe(F.col("__a")) & (F.col(_q(b)) == F.col("__b")), "left_anti")
