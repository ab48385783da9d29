"""Checks of height tiles: headers, shared edges, samples and points against the source grid.

tiles: one row per sample, tile, i, j, q, base_cm, oe, on, spacing; headers: one row per tile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import NODATA_Q, TOL_FORMULAS, TOL_QUANTISED, TOL_SLACK, corner_weights, dequantise, node, photon, polynomial, two_lerps
from .grid import cell_table, compare_samples, height_inside, tile_corners


def header_photons(tiles: DataFrame, headers: DataFrame, samples: int = 257) -> DataFrame:
    """The tiles whose header doesn't describe their own body, with both."""
    valid = F.col("q") != NODATA_Q
    body = tiles.groupBy("tile").agg(F.coalesce(F.min(F.when(valid, F.col("q"))), F.lit(0)).alias("body_min"), F.coalesce(F.max(F.when(valid, F.col("q"))), F.lit(0)).alias("body_max"), F.count_if(~valid).alias("body_nodata"))
    wrong = (F.col("samples") != samples) | ~F.col("min_q").eqNullSafe(F.col("body_min")) | ~F.col("max_q").eqNullSafe(F.col("body_max")) | ~F.col("nodata_count").eqNullSafe(F.col("body_nodata"))
    return headers.select("tile", "samples", "min_q", "max_q", "nodata_count").join(body, "tile").where(wrong)


def neighbour_tiles(headers: DataFrame, samples: int = 257) -> DataFrame:
    """a, b, side of tiles that share an edge: b lies east or north of a."""
    extent = F.round((samples - 1) * F.col("spacing")).cast("long")
    here = headers.select("tile", "oe", "on", extent.alias("extent"))
    # where several tiles have one origin, the last one counts
    there = headers.groupBy(F.col("oe").alias("e"), F.col("on").alias("n")).agg(F.max("tile").alias("b"))
    sides = F.explode(F.array(F.struct(F.lit("east").alias("side"), (F.col("oe") + F.col("extent")).alias("e"), F.col("on").alias("n")), F.struct(F.lit("north").alias("side"), F.col("oe").alias("e"), (F.col("on") + F.col("extent")).alias("n"))))
    return here.select(F.col("tile").alias("a"), sides.alias("s")).select("a", "s.side", "s.e", "s.n").join(there, ["e", "n"]).select("a", "b", "side")


def edge_samples(tiles: DataFrame, pairs: DataFrame, samples: int = 257) -> DataFrame:
    """a, b, side, sample, a_cm, b_cm, differs of all shared samples; no data equals no data."""
    last = samples - 1
    cm = tiles.select("tile", "i", "j", F.when(F.col("q") != NODATA_Q, F.col("base_cm") + F.col("q")).alias("cm"))
    east, north = F.lit("east").alias("side"), F.lit("north").alias("side")
    ends = cm.where(F.col("j") == last).select(F.col("tile").alias("a"), east, F.col("i").alias("sample"), F.col("cm").alias("a_cm"))
    ends = ends.unionByName(cm.where(F.col("i") == last).select(F.col("tile").alias("a"), north, F.col("j").alias("sample"), F.col("cm").alias("a_cm")))
    starts = cm.where("j = 0").select(F.col("tile").alias("b"), east, F.col("i").alias("sample"), F.col("cm").alias("b_cm"))
    starts = starts.unionByName(cm.where("i = 0").select(F.col("tile").alias("b"), north, F.col("j").alias("sample"), F.col("cm").alias("b_cm")))
    out = pairs.join(ends, ["a", "side"]).join(starts, ["b", "side", "sample"])
    return out.select("a", "b", "side", "sample", "a_cm", "b_cm", (~F.col("a_cm").eqNullSafe(F.col("b_cm"))).alias("differs"))


def edge_cases(edges: DataFrame, per_edge: int = 8, top: int = 8) -> DataFrame:
    """The first differing samples: at most per_edge of an edge, in order of tile, east before north."""
    nth = F.row_number().over(Window.partitionBy("a", "side").orderBy("sample"))
    return edges.where("differs").withColumn("nth", nth).where(F.col("nth") <= per_edge).drop("nth").orderBy("a", "side", "sample").limit(top)


def tile_cells(tiles: DataFrame) -> DataFrame:
    """The cell table of every tile: tile, i, j and four corners."""
    return cell_table(tiles.select("tile", "i", "j", dequantise(F.col("base_cm"), F.col("q")).alias("h")), ("tile",), "i", "j", "h")


def sample_heights(tiles: DataFrame, source: DataFrame, rows: int, cols: int, origin: tuple[float, float], spacing: float = 1.0) -> DataFrame:
    """tile, i, j, x, y, h_tile, h_source of every sample; source: cell table."""
    at = tiles.select("tile", "i", "j", node(F.col("oe"), F.col("j"), F.col("spacing")).alias("x"), node(F.col("on"), F.col("i"), F.col("spacing")).alias("y"), dequantise(F.col("base_cm"), F.col("q")).alias("h_tile"))
    at = at.withColumnsRenamed({"i": "ti", "j": "tj"}).withColumn("gx", (F.col("x") - origin[0]) / spacing).withColumn("gy", (F.col("y") - origin[1]) / spacing)
    out = height_inside(at, source, rows, cols, out="h_source")
    return out.select("tile", F.col("ti").alias("i"), F.col("tj").alias("j"), "x", "y", "h_tile", "h_source")


def worst(frame: DataFrame, error: str, *keys: str, top: int = 8) -> DataFrame:
    """Rows of the largest error; ties by the keys."""
    return frame.where(F.col(error).isNotNull()).orderBy(F.desc(error), *keys).limit(top)


def point_heights(points: DataFrame, tiles: DataFrame, headers: DataFrame, source: DataFrame, rows: int, cols: int, origin: tuple[float, float], spacing: float = 1.0, samples: int = 257) -> DataFrame:
    """points (pid, tile, u, v) with x, y, three heights in the tile (h_lerp, h_poly, h_weights) and h_source; tiles, source: cell tables."""
    corner = tile_corners(points, tiles, samples).drop("i", "j")
    c = [F.col(x) for x in ("h00", "h10", "h01", "h11", "fx", "fy")]
    got = corner.select("pid", "tile", "u", "v", two_lerps(*c).alias("h_lerp"), polynomial(*c).alias("h_poly"), corner_weights(*c).alias("h_weights"))
    got = got.join(headers.select("tile", "oe", "on", F.col("spacing").alias("sp")), "tile").withColumn("x", F.col("oe") + F.col("u") * F.col("sp")).withColumn("y", F.col("on") + F.col("v") * F.col("sp")).drop("oe", "on", "sp")
    got = got.withColumn("gx", (F.col("x") - origin[0]) / spacing).withColumn("gy", (F.col("y") - origin[1]) / spacing)
    return height_inside(got, source, rows, cols, out="h_source").drop("gx", "gy")


def point_counts(points: DataFrame) -> DataFrame:
    """One row: what the two formulas and the source disagree on."""
    a, b, s, w = (F.col(x) for x in ("h_lerp", "h_poly", "h_source", "h_weights"))
    return points.agg(
        F.count("*").alias("points"), F.count_if(a.isNull()).alias("nodata_cells"), F.count_if(s.isNull() & a.isNotNull()).alias("outside_source"),
        F.count_if(photon(a, b, TOL_FORMULAS)).alias("pair_photons"), F.max(F.abs(a - b)).alias("pair_max_m"), F.count_if(photon(a, s, TOL_QUANTISED + TOL_SLACK)).alias("source_photons"), F.max(F.abs(a - s)).alias("source_max_m"),
        F.count_if(photon(a, w, TOL_FORMULAS) | (a.isNull() != w.isNull())).alias("witness_photons"), F.max(F.abs(a - w)).alias("witness_max_m"),
    )


def check_points(points: DataFrame, keep: int = 16) -> DataFrame:
    """The first points, in order of pid, that have a height."""
    return points.where("h_lerp IS NOT NULL").select("pid", F.bround("x", 3).alias("x"), F.bround("y", 3).alias("y"), F.bround("h_lerp", 9).alias("h"), "tile").orderBy("pid").limit(keep)


def sample_counts(samples: DataFrame) -> DataFrame:
    return compare_samples(samples)


def only_in(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """The rows of a whose keys no row of b has."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")
