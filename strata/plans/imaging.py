"""Imaging-table queries: slice ordering, pixel / world / voxel geometry, slice corners,
consistency checks and voxel grids.

Stand-in slice headers are derived from ``lineitem`` x ``orders`` (one slice per line
item): study = customer, series = order, description by order key, instance = rank in
the order; orientation, position, spacing are functions of the line's values; each slice
carries one label point at pixel (4 * quantity, floor(extendedprice) mod 256).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import aggregate as A
from ..operators import geometry as GO
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import windows as W
from ..session import materialised
from .catalog import query, table

AXIAL = "Axial T2"
# The three series descriptions and the two frame orientations used.
DESCRIPTIONS = ["Sagittal T1", "Sagittal T2/STIR", AXIAL]
AXIAL_FLAT = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
AXIAL_TILT = [1.0, 0.0, 0.0, 0.0, 0.8, 0.6]
SAGITTAL = [0.0, 1.0, 0.0, 0.0, 0.0, -1.0]

_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _arr(values):
    return F.array(*[F.lit(float(v)) for v in values])


def slices(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("study_id"))
    x = li.join(o, "l_orderkey").withColumnRenamed("l_orderkey", "series_id")
    x = W.rank_within(x, "series_id", _LINE_ORDER, alias="__r")
    desc = (F.when(F.col("series_id") % 3 == 0, DESCRIPTIONS[0]).when(F.col("series_id") % 3 == 1, DESCRIPTIONS[1])
            .otherwise(DESCRIPTIONS[2]))
    x = x.select("*", desc.alias("series_description"), (F.col("__r") + 1).cast("int").alias("instance_number"))
    ax = F.col("series_description") == AXIAL
    inst = F.col("instance_number")
    orient = F.when(ax, F.when(F.col("l_linenumber") > 4, _arr(AXIAL_TILT)).otherwise(_arr(AXIAL_FLAT))) \
        .otherwise(_arr(SAGITTAL))
    pos = F.when(ax, F.array(F.lit(-100.0) + F.col("l_discount") * 100, F.lit(-100.0) + F.col("l_tax") * 100, inst * 4.0)) \
        .otherwise(F.array(inst * 3.5, F.lit(-100.0) + F.col("l_discount") * 100, F.lit(50.0) - F.col("l_tax") * 100))
    return x.select(
        "study_id", "series_id", "series_description", "instance_number", orient.alias("orientation"),
        pos.alias("position"), F.when(ax, _arr([0.5, 0.5])).otherwise(_arr([0.6, 0.6])).alias("spacing"),
        F.when(ax, F.lit(4.0)).otherwise(F.lit(3.5)).alias("gap"),
        F.when(ax, F.lit(4.0)).otherwise(F.lit(3.5)).alias("thickness"),
        F.lit(256).alias("W"), F.lit(256).alias("H"),
        (F.col("l_quantity") * 4).alias("px"), F.floor("l_extendedprice").cast("double").alias("__pe"),
    ).withColumn("py", F.col("__pe") % 256).drop("__pe")


def _materialised_order(spark, sf):
    """The ordered slice table gives the points, the stack frames and the slice look-up: written once to the shared
    checkpoint folder instead of re-running its join and ranking for each of them."""
    return materialised(GO.slice_order(slices(spark, sf)), "slices")


_SLICES_SQL = """s0 AS (SELECT o.o_custkey AS study_id, l.l_orderkey AS series_id,
  CASE l.l_orderkey % 3 WHEN 0 THEN 'Sagittal T1' WHEN 1 THEN 'Sagittal T2/STIR' ELSE 'Axial T2' END AS series_description,
  CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
    l.l_extendedprice, l.l_discount, l.l_tax) AS INTEGER) AS instance_number, l.*
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
sl AS (SELECT study_id, series_id, series_description, instance_number,
  CASE WHEN series_description = 'Axial T2' THEN CASE WHEN l_linenumber > 4 THEN [1.0, 0.0, 0.0, 0.0, 0.8, 0.6]
    ELSE [1.0, 0.0, 0.0, 0.0, 1.0, 0.0] END ELSE [0.0, 1.0, 0.0, 0.0, 0.0, -1.0] END AS orientation,
  CASE WHEN series_description = 'Axial T2' THEN [-100.0 + l_discount * 100, -100.0 + l_tax * 100, instance_number * 4.0]
    ELSE [instance_number * 3.5, -100.0 + l_discount * 100, 50.0 - l_tax * 100] END AS position,
  CASE WHEN series_description = 'Axial T2' THEN [0.5, 0.5] ELSE [0.6, 0.6] END AS spacing,
  CASE WHEN series_description = 'Axial T2' THEN 4.0 ELSE 3.5 END AS gap,
  CASE WHEN series_description = 'Axial T2' THEN 4.0 ELSE 3.5 END AS thickness, 256 AS W, 256 AS H,
  l_quantity * 4 AS px, CAST(floor(l_extendedprice) AS DOUBLE) % 256 AS py FROM s0),
nrm AS (SELECT *, [orientation[2] * orientation[6] - orientation[3] * orientation[5],
    orientation[3] * orientation[4] - orientation[1] * orientation[6],
    orientation[1] * orientation[5] - orientation[2] * orientation[4]] AS nv FROM sl),
st AS (SELECT n.*, CAST(d.stack AS INTEGER) AS stack, nv[1] * position[1] + nv[2] * position[2] + nv[3] * position[3]
    AS projection FROM nrm n JOIN (SELECT series_id, orientation, dense_rank() OVER (PARTITION BY series_id
    ORDER BY orientation) - 1 AS stack FROM (SELECT DISTINCT series_id, orientation FROM sl)) d USING (series_id, orientation)),
ord AS (SELECT *, CAST(row_number() OVER (PARTITION BY series_id, stack ORDER BY projection, instance_number) - 1 AS INTEGER) AS z,
    CAST(count(*) OVER (PARTITION BY series_id, stack) AS INTEGER) AS depth FROM st)"""


@query("slice_order", "W5 A22 F16", sql=f"""WITH {_SLICES_SQL}
SELECT series_id, instance_number, stack, z, depth, round(projection, 6) AS projection FROM ord""")
def slice_order(spark, sf):
    o = GO.slice_order(slices(spark, sf))
    return o.select("series_id", "instance_number", "stack", "z", "depth", F.round("projection", 6).alias("projection"))


_WORLD = ("[orientation[1] * spacing[1] * px + orientation[4] * spacing[2] * py + position[1], "
          "orientation[2] * spacing[1] * px + orientation[5] * spacing[2] * py + position[2], "
          "orientation[3] * spacing[1] * px + orientation[6] * spacing[2] * py + position[3]]")


@query("pixel_world", "F17", sql=f"""WITH {_SLICES_SQL}
SELECT series_id, instance_number, px, py, round(wv[1], 6) AS wx, round(wv[2], 6) AS wy, round(wv[3], 6) AS wz
FROM (SELECT *, {_WORLD} AS wv FROM sl)""")
def pixel_world(spark, sf):
    s = slices(spark, sf)
    w = G.pixel_to_world("px", "py", "orientation", "spacing", "position")
    return s.select("series_id", "instance_number", "px", "py", *[F.round(w.getItem(i - 1), 6).alias(n)
                                                                  for i, n in ((1, "wx"), (2, "wy"), (3, "wz"))])


@query("world_voxel", "F18 J8", sql=f"""WITH {_SLICES_SQL},
pts AS (SELECT study_id, series_id, instance_number, {_WORLD} AS w FROM sl),
fr AS (SELECT study_id, series_id, stack, position AS origin, orientation AS fo, spacing AS fs, gap AS fg, W, H, depth,
  nv FROM ord WHERE z = 0),
j AS (SELECT p.series_id, p.instance_number, f.stack, f.W, f.H, f.depth,
  [p.w[1] - f.origin[1], p.w[2] - f.origin[2], p.w[3] - f.origin[3]] AS d, f.fo, f.fs, f.fg, f.nv
  FROM pts p JOIN fr f ON f.study_id = p.study_id AND f.series_id = p.series_id),
ix AS (SELECT *, CAST(round_even((fo[1] * d[1] + fo[2] * d[2] + fo[3] * d[3]) / fs[1], 0) AS INTEGER) AS x,
  CAST(round_even((fo[4] * d[1] + fo[5] * d[2] + fo[6] * d[3]) / fs[2], 0) AS INTEGER) AS y,
  CAST(round_even((nv[1] * d[1] + nv[2] * d[2] + nv[3] * d[3]) / fg, 0) AS INTEGER) AS zz FROM j),
ins AS (SELECT *, x >= 0 AND x < W AND y >= 0 AND y < H AND zz >= 0 AND zz < depth AS inside FROM ix)
SELECT i.series_id, i.instance_number, i.stack, i.inside, CASE WHEN i.inside THEN i.x ELSE 0 END AS vx,
  CASE WHEN i.inside THEN i.y ELSE 0 END AS vy, CASE WHEN i.inside THEN i.zz ELSE 0 END AS vz,
  CASE WHEN i.inside THEN o.instance_number ELSE 0 END AS n
FROM ins i LEFT JOIN ord o ON i.inside AND o.series_id = i.series_id AND o.stack = i.stack AND o.z = i.zz""")
def world_voxel(spark, sf):
    ordered = _materialised_order(spark, sf)
    frames = GO.stack_frames(ordered)
    pts = ordered.select("study_id", "series_id", "instance_number",
                   G.pixel_to_world("px", "py", "orientation", "spacing", "position").alias("world"))
    out = GO.backproject(pts, frames, ordered, "world")
    return out.select("series_id", "instance_number", "stack", "inside", "vx", "vy", "vz", "n")


@query("match_points", "J8 F18", sql=f"""WITH {_SLICES_SQL},
pts AS (SELECT study_id, series_id, instance_number, {_WORLD} AS w FROM sl),
fr AS (SELECT study_id, series_id AS frame_series, stack, position AS origin, orientation AS fo, spacing AS fs, gap AS fg,
  W, H, depth, nv FROM ord WHERE z = 0),
j AS (SELECT p.series_id, p.instance_number, f.frame_series, f.stack, f.W, f.H, f.depth,
  [p.w[1] - f.origin[1], p.w[2] - f.origin[2], p.w[3] - f.origin[3]] AS d, f.fo, f.fs, f.fg, f.nv
  FROM pts p JOIN fr f ON f.study_id = p.study_id),
ix AS (SELECT *, CAST(round_even((fo[1] * d[1] + fo[2] * d[2] + fo[3] * d[3]) / fs[1], 0) AS INTEGER) AS x,
  CAST(round_even((fo[4] * d[1] + fo[5] * d[2] + fo[6] * d[3]) / fs[2], 0) AS INTEGER) AS y,
  CAST(round_even((nv[1] * d[1] + nv[2] * d[2] + nv[3] * d[3]) / fg, 0) AS INTEGER) AS zz FROM j),
ins AS (SELECT *, x >= 0 AND x < W AND y >= 0 AND y < H AND zz >= 0 AND zz < depth AS inside FROM ix)
SELECT i.series_id, i.instance_number, i.frame_series, i.stack, i.inside,
  CASE WHEN i.inside THEN i.x ELSE 0 END AS vx, CASE WHEN i.inside THEN i.y ELSE 0 END AS vy,
  CASE WHEN i.inside THEN i.zz ELSE 0 END AS vz, CASE WHEN i.inside THEN o.instance_number ELSE 0 END AS n
FROM ins i LEFT JOIN ord o ON i.inside AND o.series_id = i.frame_series AND o.stack = i.stack AND o.z = i.zz""")
def match_points_q(spark, sf):
    """J8 unconditional form: every label point projected to every volume (stack) of its
    study, not only those of its own series."""
    ordered = _materialised_order(spark, sf)
    frames = GO.stack_frames(ordered)
    pts = ordered.select("study_id", "series_id", "instance_number",
                   G.pixel_to_world("px", "py", "orientation", "spacing", "position").alias("world"))
    out = GO.backproject(pts, frames, ordered, "world", same_series=False)
    return out.select("series_id", "instance_number", "frame_series", "stack", "inside", "vx", "vy", "vz", "n")


@query("inside_boxes", "J8", sql="""
WITH p AS (SELECT o_orderkey, o_orderstatus AS study, CAST(o_orderkey % 50 AS DOUBLE) AS x, CAST(o_custkey % 11 AS DOUBLE) AS y,
  o_totalprice / 4000 AS z FROM orders),
b AS (SELECT p_partkey, substr('FOP', CAST(1 + p_partkey % 3 AS INTEGER), 1) AS study, p_size - (p_partkey % 5) * 0.25 AS x0,
  p_size + (p_partkey % 5) * 0.25 AS x1, p_partkey % 11 - 0.5 AS y0, p_partkey % 11 + 0.5 AS y1,
  p_retailprice / 20 - (1 + p_partkey % 7) AS z0, p_retailprice / 20 + (1 + p_partkey % 7) AS z1 FROM part),
n AS (SELECT study, count(*) AS boxes FROM b GROUP BY study)
SELECT o_orderkey, count(p_partkey) AS n_inside, min(p_partkey) AS first_box, coalesce(any_value(boxes), 0) - count(p_partkey) AS n_missed
FROM p LEFT JOIN b ON b.study = p.study AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AND z BETWEEN z0 AND z1
LEFT JOIN n ON n.study = p.study GROUP BY o_orderkey""")
def inside_boxes(spark, sf):
    """Orders as points of three large studies, parts as boxes of many sizes."""
    p = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("study"),
                                          (F.col("o_orderkey") % 50).cast("double").alias("x"),
                                          (F.col("o_custkey") % 11).cast("double").alias("y"), (F.col("o_totalprice") / 4000).alias("z"))
    key, half = F.col("p_partkey"), (F.col("p_partkey") % 5) * 0.25
    deep = 1 + key % 7
    b = table(spark, sf, "part").select(
        "p_partkey", F.substring(F.lit("FOP"), (1 + key % 3).cast("int"), F.lit(1)).alias("study"),
        (F.col("p_size") - half).alias("x0"), (F.col("p_size") + half).alias("x1"), (key % 11 - 0.5).alias("y0"), (key % 11 + 0.5).alias("y1"),
        (F.col("p_retailprice") / 20 - deep).alias("z0"), (F.col("p_retailprice") / 20 + deep).alias("z1"))
    return J.box_counts(p, b, ["o_orderkey"], "study", ["x", "y", "z"], ["x0", "y0", "z0"], ["x1", "y1", "z1"], "p_partkey")


@query("slice_corners", "F22", sql=f"""WITH {_SLICES_SQL}
SELECT series_id, instance_number, list_transform(c, lambda p: list_transform(p, lambda v: round(v, 6))) AS corners FROM
 (SELECT series_id, instance_number, [position,
   [position[1] + W * spacing[1] * orientation[1], position[2] + W * spacing[1] * orientation[2],
    position[3] + W * spacing[1] * orientation[3]],
   [position[1] + H * spacing[2] * orientation[4], position[2] + H * spacing[2] * orientation[5],
    position[3] + H * spacing[2] * orientation[6]],
   [position[1] + H * spacing[2] * orientation[4] + W * spacing[1] * orientation[1],
    position[2] + H * spacing[2] * orientation[5] + W * spacing[1] * orientation[2],
    position[3] + H * spacing[2] * orientation[6] + W * spacing[1] * orientation[3]]] AS c FROM sl)""")
def slice_corners(spark, sf):
    s = slices(spark, sf)
    c = G.slice_corners("orientation", "spacing", "position", "W", "H")
    return s.select("series_id", "instance_number",
                    F.transform(c, lambda p: F.transform(p, lambda v: F.round(v, 6))).alias("corners"))


@query("slice_consistency", "A16", sql=f"""WITH {_SLICES_SQL}
SELECT series_id, count(DISTINCT thickness) AS n_thickness, count(DISTINCT orientation) AS n_orientation,
  count(DISTINCT spacing) AS n_spacing FROM sl GROUP BY series_id
HAVING count(DISTINCT thickness) > 1 OR count(DISTINCT orientation) > 1 OR count(DISTINCT spacing) > 1""")
def slice_consistency(spark, sf):
    return GO.slice_consistency(slices(spark, sf))


# ---------------------------------------------------------------- voxel grid

# Series kind per return flag and channel per series kind.
KIND = {"A": "T1", "N": "T2", "R": "T2/STIR"}
CHANNEL = {"T1": 0, "T2": 1, "T2/STIR": 2}
GRID = 16


@query("voxelize", "A20 U6 U7 U9 F19", sql=f"""
WITH p AS (SELECT l_suppkey AS study_id, CASE l_returnflag WHEN 'A' THEN 'T1' WHEN 'N' THEN 'T2' WHEN 'R' THEN 'T2/STIR' END AS kind,
  l_quantity AS row_i, l_discount * 100 AS col_i, l_extendedprice AS val, 1 + l_linenumber % 3 AS thick,
  l_tax * 100 AS pos0, CAST(l_linenumber AS DOUBLE) AS pos1, 0.0 AS pos2 FROM lineitem WHERE l_extendedprice <> 0),
r AS (SELECT p.*, c.copy FROM p, LATERAL (SELECT unnest(range(0, p.thick)) AS copy) c),
s AS (SELECT study_id, kind, row_i, col_i, val,
  CASE WHEN kind = 'T2' THEN pos0 ELSE pos0 + copy * 1.0 END AS pos0, pos1,
  CASE WHEN kind = 'T2' THEN pos2 + copy * 1.0 ELSE pos2 END AS pos2,
  CASE WHEN kind = 'T2' THEN [1.0, 0.0, 0.0, 0.0, 1.0, 0.0] ELSE [0.0, 1.0, 0.0, 0.0, 0.0, -1.0] END AS o FROM r),
w AS (SELECT study_id, CASE kind WHEN 'T1' THEN 0 WHEN 'T2' THEN 1 ELSE 2 END AS ch, val,
  o[1] * 0.5 * col_i + o[4] * 0.5 * row_i + pos0 AS x, o[2] * 0.5 * col_i + o[5] * 0.5 * row_i + pos1 AS y,
  o[3] * 0.5 * col_i + o[6] * 0.5 * row_i + pos2 AS z FROM s),
b AS (SELECT study_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM w GROUP BY study_id),
c AS (SELECT w.study_id, w.ch, w.val,
  CAST(CASE WHEN x1 > x0 THEN round_even((x - x0) * {float(GRID - 1)} / (x1 - x0), 0) ELSE 0 END AS INTEGER) AS ix,
  CAST(CASE WHEN y1 > y0 THEN round_even((y - y0) * {float(GRID - 1)} / (y1 - y0), 0) ELSE 0 END AS INTEGER) AS iy,
  CAST(CASE WHEN z1 > z0 THEN round_even((z - z0) * {float(GRID - 1)} / (z1 - z0), 0) ELSE 0 END AS INTEGER) AS iz
  FROM w JOIN b USING (study_id))
SELECT study_id, ix, iy, iz, ch, greatest(max(val), 0.0) AS value FROM c GROUP BY study_id, ix, iy, iz, ch
HAVING greatest(max(val), 0.0) > 0""")
def voxelize(spark, sf):
    li = table(spark, sf, "lineitem")
    pairs = []
    for k, v in KIND.items():
        pairs += [F.lit(k), F.lit(v)]
    p = li.select(F.col("l_suppkey").alias("study_id"),
                  F.element_at(F.create_map(*pairs), F.col("l_returnflag")).alias("kind"),
                  F.col("l_quantity").alias("row_i"), (F.col("l_discount") * 100).alias("col_i"),
                  F.col("l_extendedprice").alias("val"), (1 + F.col("l_linenumber") % 3).alias("thick"),
                  (F.col("l_tax") * 100).alias("pos0"), F.col("l_linenumber").cast("double").alias("pos1"),
                  F.lit(0.0).alias("pos2")).filter(F.col("val") != 0)  # U9: only non-zero values are points
    t2 = F.col("kind") == "T2"
    r = R.replicate(p, "thick", {"pos2": t2, "pos0": ~t2}, step=1.0)
    orient = F.when(t2, _arr(AXIAL_FLAT)).otherwise(_arr(SAGITTAL))
    world = G.affine_to_world(F.col("row_i"), F.col("col_i"), orient, _arr([0.5, 0.5]),
                              F.array("pos0", "pos1", "pos2"))
    pts = r.select("study_id", R.to_channel("kind", CHANNEL).alias("ch"), "val", world.alias("w")).select(
        "study_id", "ch", "val", *[F.col("w").getItem(i - 1).alias(n) for i, n in ((1, "x"), (2, "y"), (3, "z"))])
    return A.voxelize(pts, "study_id", GRID, xyz=("x", "y", "z"), channel="ch", value="val")
