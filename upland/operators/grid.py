"""Height grids as frames: one row (r, c, z) per node, r from the south, z NULL for no data.

Lookups of four corners go through a cell table, built once with window functions, so a point needs
one equi-join. Every spatial join here is an equi-join on cells or tiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import NODATA_Q, TILE_M, centimetres, exact_at_nodes, lerp, photon, TOL_QUANTISED, TOL_SLACK

RELIEF_LIMIT = NODATA_Q


def lattice(spark, height: int, width: int) -> DataFrame:
    """All nodes (r, c) of a height x width grid."""
    return spark.range(height * width).select(F.floor(F.col("id") / width).cast("int").alias("r"), (F.col("id") % width).cast("int").alias("c"))


def chunk_ranges(frame: DataFrame, lo: str = "lo", hi: str = "hi", step: int = 1000) -> DataFrame:
    """Half-open ranges [a, b) of at most `step` that cover [lo, hi), with the frame's columns."""
    some = frame.where(F.col(lo) < F.col(hi))
    return some.withColumn("a", F.explode(F.sequence(F.col(lo), F.col(hi) - 1, F.lit(step)))).withColumn("b", F.least(F.col("a") + step, F.col(hi)))


def chunk_plan(frame: DataFrame, step: int = 1000) -> DataFrame:
    """Boxes (e0, e1, n0, n1) of at most step x step, for frames of one box e_lo, e_hi, n_lo, n_hi a row."""
    e = chunk_ranges(frame, "e_lo", "e_hi", step).withColumnsRenamed({"a": "e0", "b": "e1"})
    return chunk_ranges(e, "n_lo", "n_hi", step).withColumnsRenamed({"a": "n0", "b": "n1"})


def mosaic(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    """nodes (r, c) with z from pieces (chunk, r, c, z): the first chunk in order that has a height wins."""
    first = pieces.where("z IS NOT NULL").groupBy("r", "c").agg(F.min_by("z", "chunk").alias("z"))
    return nodes.select("r", "c").join(first, ["r", "c"], "left")


def merge_tiles(nodes: DataFrame, tiles: DataFrame) -> DataFrame:
    """nodes (r, c) with z from tiles (tile, r, c, z): the last tile wins, also where it has no height."""
    last = tiles.groupBy("r", "c").agg(F.max_by(F.struct("z"), "tile").alias("top")).select("r", "c", F.col("top.z").alias("z"))
    return nodes.select("r", "c").join(last, ["r", "c"], "left")


def tiles_of(index: Column, last: Column, tile_m: int = TILE_M) -> Column:
    """The tiles, one or two, that a row or column belongs to: nodes on a shared edge are in both."""
    own = F.floor(index / tile_m).cast("int")
    both = F.when(index % tile_m == 0, F.array(own - 1, own)).otherwise(F.array(own))
    return F.filter(both, lambda t: (t >= 0) & (t <= last))


def cut(grid: DataFrame, rows: int, cols: int, tile_m: int = TILE_M) -> DataFrame:
    """ix, iy, i, j and the grid's columns: every node in each tile that holds it (rows, cols: nodes a side)."""
    if rows <= tile_m or cols <= tile_m:
        raise ValueError(f"the grid needs {tile_m + 1} nodes a side at least")
    last = lambda n: F.lit(-(-(n - 1) // tile_m) - 1)
    out = grid.withColumn("ix", F.explode(tiles_of(F.col("c"), last(cols), tile_m))).withColumn("iy", F.explode(tiles_of(F.col("r"), last(rows), tile_m)))
    return out.withColumn("i", (F.col("r") - F.col("iy") * tile_m).cast("int")).withColumn("j", (F.col("c") - F.col("ix") * tile_m).cast("int"))


def quantise(tiles: DataFrame, key: tuple[str, ...] = ("ix", "iy")) -> DataFrame:
    """base_cm and q beside each node of tiles with z; an error if a tile's relief doesn't fit 16 bits."""
    w = Window.partitionBy(*key)
    cm = tiles.withColumn("cm", centimetres(F.col("z")))
    cm = cm.withColumn("base_cm", F.coalesce(F.min("cm").over(w), F.lit(0)))
    q = F.when(F.col("cm").isNull(), NODATA_Q).when(F.col("cm") - F.col("base_cm") < RELIEF_LIMIT, F.col("cm") - F.col("base_cm")).otherwise(F.raise_error(F.lit("tile relief exceeds 655.34 m")).cast("long"))
    return cm.withColumn("q", q.cast("int")).drop("cm")


def tile_summary(quantised: DataFrame, samples: int, key: tuple[str, ...] = ("ix", "iy")) -> DataFrame:
    """base_cm, min_q, max_q, nodata, min_m, max_m of each tile; nodes that no row gives count as no data."""
    valid = F.col("q") != NODATA_Q
    out = quantised.groupBy(*key).agg(F.first("base_cm").alias("base_cm"), F.count_if(valid).alias("n"), F.min(F.when(valid, F.col("q"))).alias("lo"), F.max(F.when(valid, F.col("q"))).alias("hi"))
    return out.select(
        *key, "base_cm", F.coalesce("lo", F.lit(0)).alias("min_q"), F.coalesce("hi", F.lit(0)).alias("max_q"), (F.lit(samples * samples) - F.col("n")).alias("nodata"),
        F.when(F.col("n") > 0, (F.col("base_cm") + F.col("lo")) / 100.0).alias("min_m"), F.when(F.col("n") > 0, (F.col("base_cm") + F.col("hi")) / 100.0).alias("max_m"),
    )


def cell_table(grid: DataFrame, key: tuple[str, ...] = (), row: str = "r", col: str = "c", z: str = "z") -> DataFrame:
    """key, i, j, h00, h10, h01, h11 of each cell, named by its south-west node; needs a row per node."""
    east = Window.partitionBy(*key, row).orderBy(col)
    north = Window.partitionBy(*key, col).orderBy(row)
    pairs = grid.select(*key, row, col, F.col(z).alias("h00"), F.lead(z).over(east).alias("h10"), F.lead(F.lit(True)).over(east).alias("has_east"))
    pairs = pairs.withColumn("h01", F.lead("h00").over(north)).withColumn("h11", F.lead("h10").over(north)).withColumn("has_north", F.lead(F.lit(True)).over(north))
    return pairs.where("has_east AND has_north").select(*key, F.col(row).alias("i"), F.col(col).alias("j"), "h00", "h10", "h01", "h11")


def _clipped(x: Column, last_cell: Column) -> Column:
    return F.least(F.greatest(F.floor(x), F.lit(0)), last_cell).cast("int")


def height_inside(points: DataFrame, cells: DataFrame, rows: int, cols: int, gx: str = "gx", gy: str = "gy", out: str = "h") -> DataFrame:
    """Bilinear height at fractional indices: NULL outside the grid, exact at nodes."""
    at = points.withColumn("j", _clipped(F.col(gx), F.lit(cols - 2))).withColumn("i", _clipped(F.col(gy), F.lit(rows - 2)))
    f = lambda g, k: F.least(F.greatest(F.col(g) - F.col(k), F.lit(0.0)), F.lit(1.0))
    inside = F.col(gx).between(0, cols - 1) & F.col(gy).between(0, rows - 1)
    h = exact_at_nodes(F.col("h00"), F.col("h10"), F.col("h01"), F.col("h11"), f(gx, "j"), f(gy, "i"))
    return at.join(cells, ["i", "j"], "left").withColumn(out, F.when(inside, h)).drop("i", "j", "h00", "h10", "h01", "h11")


def ground_height(points: DataFrame, cells: DataFrame, rows: int, cols: int, x: str = "x", y: str = "y", spacing: float = 1.0, out: str = "h") -> DataFrame:
    """Bilinear height at local metres: outside, the nearest cell goes on linearly; a missing corner gives NULL."""
    at = points.withColumn("gx", F.col(x) / spacing).withColumn("gy", F.col(y) / spacing)
    at = at.withColumn("j", _clipped(F.col("gx"), F.lit(cols - 2))).withColumn("i", _clipped(F.col("gy"), F.lit(rows - 2)))
    fx, fy = F.col("gx") - F.col("j"), F.col("gy") - F.col("i")
    h = lerp(lerp(F.col("h00"), F.col("h10"), fx), lerp(F.col("h01"), F.col("h11"), fx), fy)
    return at.join(cells, ["i", "j"], "left").withColumn(out, h).drop("i", "j", "gx", "gy", "h00", "h10", "h01", "h11")


def tile_corners(points: DataFrame, cells: DataFrame, samples: int) -> DataFrame:
    """Corners and fractions (fx, fy) of points (tile, u, v) in tile cells (tile, i, j, h00 ..)."""
    at = points.withColumn("j", _clipped(F.col("u"), F.lit(samples - 2))).withColumn("i", _clipped(F.col("v"), F.lit(samples - 2)))
    return at.join(cells, ["tile", "i", "j"], "left").withColumn("fx", F.col("u") - F.col("j")).withColumn("fy", F.col("v") - F.col("i"))


def same_mask(a: DataFrame, b: DataFrame) -> DataFrame:
    """mask_equal, mismatches, max_err_m of two grids (r, c, z)."""
    both = a.select("r", "c", F.col("z").alias("za")).join(b.select("r", "c", F.col("z").alias("zb")), ["r", "c"], "full_outer")
    differ = F.col("za").isNull() != F.col("zb").isNull()
    return both.agg((F.count_if(differ) == 0).alias("mask_equal"), F.count_if(differ).alias("mismatches"), F.max(F.abs(F.col("za") - F.col("zb"))).alias("max_err_m"))


def compare_samples(pairs: DataFrame, tile: str = "h_tile", source: str = "h_source") -> DataFrame:
    """One row of counts for heights of two origins at the same places."""
    a, b = F.col(tile), F.col(source)
    return pairs.agg(
        F.count("*").alias("samples"), F.count_if(a.isNull() & b.isNull()).alias("nodata_both"), F.count_if(a.isNull() != b.isNull()).alias("nodata_mismatch"),
        (F.count_if(photon(a, b, TOL_QUANTISED + TOL_SLACK)) + F.count_if(a.isNull() != b.isNull())).alias("photons"), F.max(F.abs(a - b)).alias("max_err_m"),
    )
