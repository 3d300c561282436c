"""3-vector column functions on ``array<double>`` columns.  Ids: F16, F17, F19, F22.

Vectors are 3-element arrays, orientations 6-element arrays (row direction, then
column direction), pixel spacings 2-element arrays.  Everything is plain arithmetic on
``getItem`` so it stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _e(a, i: int) -> Column:
    """1-based element ``i`` (``getItem`` compiles in generated code where a nested
    ``element_at`` of a conditional array does not)."""
    return _c(a).getItem(i - 1)


def vec3(x, y, z) -> Column:
    return F.array(x, y, z)


def dot3(a, b) -> Column:
    """F16: dot product of two 3-vectors."""
    return _e(a, 1) * _e(b, 1) + _e(a, 2) * _e(b, 2) + _e(a, 3) * _e(b, 3)


def cross3(a, b) -> Column:
    """F16: cross product of two 3-vectors."""
    return vec3(_e(a, 2) * _e(b, 3) - _e(a, 3) * _e(b, 2),
                _e(a, 3) * _e(b, 1) - _e(a, 1) * _e(b, 3),
                _e(a, 1) * _e(b, 2) - _e(a, 2) * _e(b, 1))


def row_dir(orient) -> Column:
    return F.slice(_c(orient), 1, 3)


def col_dir(orient) -> Column:
    return F.slice(_c(orient), 4, 3)


def normal(orient) -> Column:
    """F16: slice normal = row direction x column direction."""
    return cross3(row_dir(orient), col_dir(orient))


def projection(orient, position) -> Column:
    """F16: position of a slice along its normal."""
    return dot3(normal(orient), position)


def pixel_to_world(x, y, orient, spacing, position) -> Column:
    """``X = o0*dx*x + o3*dy*y + sx`` (and the same for Y, Z)."""
    o, s, p = _c(orient), _c(spacing), _c(position)
    dx, dy = _e(s, 1), _e(s, 2)
    return vec3(*[_e(o, i) * dx * _c(x) + _e(o, i + 3) * dy * _c(y) + _e(p, i)
                  for i in (1, 2, 3)])


def affine_to_world(row, col, orient, spacing, position, f_row=1.0, f_col=1.0) -> Column:
    """the 4x4 affine ``[X*dX, Y*dY, 0, S]`` applied after the pixel-axis swap: the
    image's first axis (row) runs along the column direction and the second (col) along
    the row direction, each scaled by its resize factor."""
    o, s, p = _c(orient), _c(spacing), _c(position)
    dx, dy = _e(s, 1), _e(s, 2)
    a = _c(col) * F.lit(f_col)
    b = _c(row) * F.lit(f_row)
    return vec3(*[_e(o, i) * dx * a + _e(o, i + 3) * dy * b + _e(p, i)
                  for i in (1, 2, 3)])


def world_to_index(world, origin, orient, spacing, slice_gap) -> Column:
    """F18 (arithmetic part): world point relative to the stack origin projected on the
    row direction, column direction and normal, divided by the spacings, rounded half
    to even -> ``array<int>(x, y, z)``."""
    d = F.array(*[_e(world, i) - _e(origin, i) for i in (1, 2, 3)])
    s = _c(spacing)
    x = F.bround(dot3(row_dir(orient), d) / _e(s, 1), 0)
    y = F.bround(dot3(col_dir(orient), d) / _e(s, 2), 0)
    z = F.bround(dot3(normal(orient), d) / _c(slice_gap), 0)
    return F.array(x.cast("int"), y.cast("int"), z.cast("int"))


def slice_corners(orient, spacing, position, width, height) -> Column:
    """the four corner points of a slice plane: s, s + W dx ox, s + H dy oy, both."""
    o, s, p = _c(orient), _c(spacing), _c(position)
    dx, dy = _e(s, 1), _e(s, 2)
    w, h = _c(width), _c(height)

    def pt(fw, fh):
        return vec3(*[_e(p, i) + fh * h * dy * _e(o, i + 3) + fw * w * dx * _e(o, i)
                      for i in (1, 2, 3)])

    return F.array(pt(0, 0), pt(1, 0), pt(0, 1), pt(1, 1))
