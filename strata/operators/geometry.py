"""Slice-table geometry.  Ids: W5, F18, J8, A16 (with A22 stacks; F16/F17/F19/F22 are
column functions in ``strata.functions.geometry``).

A slice table has one row per image: ``series``, ``instance``, orientation (6),
position (3), pixel spacing (2), slice gap, width, height.  Stacks (A22) split a series
by orientation; the z index of a slice is its rank by projection on the normal inside
its stack, computed with the skew-safe :func:`rank_within`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from .aggregate import assert_constant, split_stacks
from .joins import match_points
from .schema import _q
from .windows import rank_within, split_hot

LIST_ROWS = 256  # a stack up to this depth carries its instance numbers


def slice_order(slices: DataFrame, series: str = "series_id", orientation: str = "orientation",
                position: str = "position", instance: str = "instance_number") -> DataFrame:
    """W5 (+A22, F16): adds ``stack`` (orientation group within the series), the
    ``projection`` of the position on the slice normal, the 0-based ``z`` rank by
    projection inside the stack (ties by instance) and the stack ``depth``.  The slices of a series are partitioned
    and sorted once for all of these; only series of more than ``HOT_ROWS`` slices are spread over tasks."""
    small, hot = split_hot(slices, [series])
    group = Window.partitionBy(_q(series), _q(orientation))
    ranked = small.withColumns({
        "stack": F.dense_rank().over(Window.partitionBy(_q(series)).orderBy(_q(orientation))) - 1,
        "projection": G.projection(F.col(orientation), F.col(position))})
    ranked = ranked.withColumns({"depth": F.count(F.lit(1)).over(group).cast("int"),
                                 "z": (F.row_number().over(group.orderBy("projection", _q(instance))) - 1).cast("int")})
    if hot is None:
        return ranked
    st = split_stacks(hot, series, orientation, alias="stack")
    st = st.withColumn("projection", G.projection(F.col(orientation), F.col(position)))
    r = rank_within(st, [series, "stack"], ["projection", instance], alias="z", count_alias="depth")
    return ranked.unionByName(r.withColumn("z", F.col("z").cast("int")).withColumn("depth", F.col("depth").cast("int")))


def stack_frames(ordered: DataFrame, study: str = "study_id", series: str = "series_id",
                 orientation: str = "orientation", position: str = "position", spacing: str = "spacing",
                 gap: str = "gap", width: str = "W", height: str = "H") -> DataFrame:
    """One row per stack: the first slice's frame (origin, orientation, spacings) and the
    volume shape (depth, height, width)."""
    return ordered.filter(F.col("z") == 0).select(
        study, series, "stack", F.col(position).alias("origin"), F.col(orientation).alias("frame_orientation"),
        F.col(spacing).alias("frame_spacing"), F.col(gap).alias("frame_gap"), F.col(width).alias("frame_W"),
        F.col(height).alias("frame_H"), F.col("depth").alias("frame_D"))


def backproject(points: DataFrame, frames: DataFrame, ordered: DataFrame, world: str = "world",
                study: str = "study_id", series: str = "series_id", same_series: bool = True,
                instance: str = "instance_number", list_rows: int = LIST_ROWS) -> DataFrame:
    """F18 + J8: every world point against every stack of its study (and series when
    ``same_series``; otherwise projected to all volumes of the study): pixel / slice
    indices by projection on the stack axes, rounded half to even; ``inside`` when
    0 <= x < W, 0 <= y < H, 0 <= z < D; inside points get the instance number of slice z;
    outside -> (false, 0, 0, 0, 0).  The study (and series) equality is the join key.

    The frame of a stack of at most ``list_rows`` slices carries their instance numbers, so the projected rows are not
    moved again; those of deeper stacks are joined with the slices."""
    short = F.coalesce(F.col("frame_D") <= list_rows, F.lit(False))
    names = (ordered.filter(F.col("depth") <= list_rows).groupBy(F.col(series).alias("__s"), F.col("stack").alias("__st"))
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("z", F.col(instance).alias("n")))), lambda s: s["n"]).alias("__names")))
    fr = frames.withColumnRenamed(series, "frame_series")
    listed = fr.filter(short).join(names, (F.col("frame_series") == F.col("__s")) & (F.col("stack") == F.col("__st")), "left").drop("__s", "__st")
    extra = ["__names", "origin", "frame_orientation", "frame_spacing", "frame_gap", "frame_W", "frame_H", "frame_D"]
    out = _projected(points, listed, world, study, series, same_series)
    out = out.withColumn("n", F.when(F.col("inside"), F.get("__names", F.col("vz").cast("int"))).otherwise(0)).drop(*extra)
    look = ordered.filter(F.col("depth") > list_rows).select(
        F.col(series).alias("__s"), F.col("stack").alias("__st"), F.col("z").alias("__z"), F.col(instance).alias("n"))
    deep = _projected(points, fr.filter(~short), world, study, series, same_series).join(
        look, (F.col("frame_series") == F.col("__s")) & (F.col("stack") == F.col("__st")) & (F.col("vz") == F.col("__z"))
        & F.col("inside"), "left")
    deep = deep.withColumn("n", F.when(F.col("inside"), F.col("n")).otherwise(0)).drop("__s", "__st", "__z", *extra)
    return out.unionByName(deep)


def _projected(points: DataFrame, fr: DataFrame, world: str, study: str, series: str, same_series: bool) -> DataFrame:
    if same_series:
        j = points.join(fr, (points[study] == fr[study]) & (points[series] == fr["frame_series"])).drop(fr[study])
    else:
        j = match_points(points, fr, study, None)
    j = j.withColumn("__idx", G.world_to_index(F.col(world), F.col("origin"), F.col("frame_orientation"), F.col("frame_spacing"),
                                               F.col("frame_gap")))
    x, y, z = (F.col("__idx").getItem(i) for i in (0, 1, 2))
    inside = ((x >= 0) & (x < F.col("frame_W")) & (y >= 0) & (y < F.col("frame_H")) & (z >= 0)
              & (z < F.col("frame_D")))
    return (j.withColumn("inside", inside).withColumn("vx", F.when(inside, x).otherwise(0))
            .withColumn("vy", F.when(inside, y).otherwise(0)).withColumn("vz", F.when(inside, z).otherwise(0)).drop("__idx"))


def slice_consistency(slices: DataFrame, series: str = "series_id",
                      cols: Sequence[str] = ("thickness", "orientation", "spacing")) -> DataFrame:
    """Series whose thickness, orientation or spacing is not constant."""
    return assert_constant(slices, series, list(cols))
