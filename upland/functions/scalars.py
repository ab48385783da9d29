"""Column functions on heights, slopes and routes. No-data is NULL everywhere, never NaN.

greatest() and least() skip NULL in Spark, so wherever a missing height must stay missing the
functions here test for it first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the surveying rules.
SLOPE_EDGES = (2.0, 5.0, 10.0, 15.0, 25.0)
SLOPE_LABELS = ("0-2", "2-5", "5-10", "10-15", "15-25", ">25")
FLAT_PERCENT, FLAT, NODATA_CLASS = 0.5, 8, 255
TOL_QUANTISED, TOL_SLACK, TOL_FORMULAS = 0.005, 1e-9, 1e-9
TOL_SLOPE_PP, TOL_WITNESS = 1.0, 1e-9
TOL_VOLUME, TOL_LENGTH = 0.005, 1e-3
CHUNK_M, TILE_M = 1000, 256
NODATA_Q = 65535


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value written and worked out once, as a lambda's argument."""
    return F.element_at(F.transform(F.array(value), body), 1)


def nan_to_null(x: Column) -> Column:
    """Non-finite values become NULL."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def mask_nodata(z: Column, nodata: Column | None = None) -> Column:
    """NULL for non-finite heights, heights below -1000 m and those equal to the raster's no-data value."""
    bad = F.isnan(z) | (F.abs(z) == float("inf")) | (z < -1000.0)
    if nodata is not None:
        finite = nodata.isNotNull() & ~F.isnan(nodata) & (F.abs(nodata) != float("inf"))
        bad = bad | F.coalesce(finite & (F.abs(z - nodata) <= F.abs(nodata) * 1e-6 + 1e-6), F.lit(False))
    return F.when(bad, None).otherwise(z)


def raw_nodata(text: Column) -> Column:
    """A no-data tag's text as a double, NULL if it is none."""
    return F.trim(F.replace(text, F.lit("\0"), F.lit(""))).try_cast("double")


def centimetres(z: Column) -> Column:
    """Whole centimetres, ties to even."""
    return F.rint(z * 100.0).cast("long")


def dequantise(base_cm: Column, q: Column) -> Column:
    return F.when(q != NODATA_Q, (base_cm + q) / 100.0)


def node(origin: Column, index: Column, spacing: Column) -> Column:
    return origin + index * spacing


def snapped(centre: Column, size: Column) -> Column:
    """South or west side of a box about centre, snapped to tiles; an error unless size is whole tiles."""
    side = (F.floor((centre - size / 2) / TILE_M + 0.5) * TILE_M).cast("long")
    return F.when((size > 0) & (size % TILE_M == 0), side).otherwise(F.raise_error(F.lit("size must be a positive multiple of 256")).cast("long"))


def slope_percent(p: Column, q: Column) -> Column:
    return 100.0 * F.sqrt(p * p + q * q)


def slope_class(s: Column) -> Column:
    """Class k on [edge k-1, edge k); 255 for no data."""
    found = reduce(lambda w, k: w.when(s >= SLOPE_EDGES[k - 1], k), range(len(SLOPE_EDGES), 0, -1), F.when(s.isNull(), NODATA_CLASS))
    return found.otherwise(0)


def octant(p: Column, q: Column, s: Column) -> Column:
    """Downslope eighth of the compass (0 = N, clockwise), 8 if flat, 255 for no data."""
    turn = F.pmod(F.degrees(F.atan2(-p, -q)) + 360.0, F.lit(360.0))
    eighth = F.pmod(F.floor(turn / 45.0 + 0.5), F.lit(8)).cast("int")
    return F.when(s.isNull(), NODATA_CLASS).when(s < FLAT_PERCENT, FLAT).otherwise(eighth)


def photon(a: Column, b: Column, tolerance: float) -> Column:
    """Whether two values differ by more than the tolerance; false if one is missing."""
    return F.coalesce(F.abs(a - b) > tolerance, F.lit(False))


def disagreement(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) / F.greatest(a, b, F.lit(1e-12)))


def floor0(x: Column) -> Column:
    """max(x, 0), NULL for NULL."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def lerp(a: Column, b: Column, f: Column) -> Column:
    return a + (b - a) * f


def two_lerps(h00: Column, h10: Column, h01: Column, h11: Column, fx: Column, fy: Column) -> Column:
    return lerp(lerp(h00, h10, fx), lerp(h01, h11, fx), fy)


def polynomial(h00: Column, h10: Column, h01: Column, h11: Column, fx: Column, fy: Column) -> Column:
    return h00 + (h10 - h00) * fx + (h01 - h00) * fy + (h11 - h10 - h01 + h00) * fx * fy


def corner_weights(h00: Column, h10: Column, h01: Column, h11: Column, fx: Column, fy: Column) -> Column:
    return h00 * (1 - fx) * (1 - fy) + h10 * fx * (1 - fy) + h01 * (1 - fx) * fy + h11 * fx * fy


def exact_at_nodes(h00: Column, h10: Column, h01: Column, h11: Column, fx: Column, fy: Column) -> Column:
    """Bilinear height for which corners of weight zero don't matter, even if missing."""

    def along(a: Column, b: Column, f: Column) -> Column:
        return F.when(f == 0, a).when(f == 1, b).otherwise(lerp(a, b, f))

    return along(along(h00, h10, fx), along(h01, h11, fx), fy)


def arc_point(x: Column, y: Column, heading: Column, curvature: Column, u: Column) -> tuple[Column, Column]:
    """The point u along a piece that starts at (x, y)."""
    half = curvature * u / 2
    chord = F.when(half == 0, u).otherwise(u * F.sin(half) / half)
    return x + chord * F.cos(heading + half), y + chord * F.sin(heading + half)


def arc_length_integral(u: Column) -> Column:
    """Antiderivative of sqrt(1 + u^2)."""
    return (u * F.sqrt(1 + u * u) + F.asinh(u)) / 2


def pick(*names: Column) -> Column:
    """First of several spellings of a setting."""
    return F.coalesce(*names)


def local_number(origin: Column, value: Column) -> Column:
    return value - origin
