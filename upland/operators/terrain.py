"""Slope, aspect and curvature from 3x3 neighbourhoods, by two plans and a witness.

The plans read neighbourhoods from halo tiles: a node goes to its tile and to those beside it that need it, so one
shuffle brings all nine nodes together; that needs a row per node (NULL where there is no height). The witness scatters
every height to its neighbours' sums with a kernel's weights and keeps the nodes that got all nine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import NODATA_CLASS, SLOPE_EDGES, SLOPE_LABELS, TOL_SLOPE_PP, TOL_WITNESS, octant, photon, slope_class, slope_percent

#: Nodes of a halo tile's side.
HALO_TILE = 256
#: Bins of a pass of exact_quantile, and values that are sorted at last.
BINS, LAST_VALUES = 4096, 100_000


def _along() -> WindowSpec:
    return Window.partitionBy("r").orderBy("c")


def _across() -> WindowSpec:
    return Window.partitionBy("c").orderBy("r")


#: Names of the neighbours and where they lie: north row a b c_, middle d z f, south g h k.
AROUND = {"z": (0, 0), "a": (1, -1), "b": (1, 0), "c_": (1, 1), "d": (0, -1), "f": (0, 1), "g": (-1, -1), "h": (-1, 0), "k": (-1, 1)}


def neighbours(grid: DataFrame, size: int | None = None) -> DataFrame:
    """r, c, z and the eight neighbours' heights a b c_ d f g h k, of interior nodes."""
    size = size or HALO_TILE

    def near(axis: str) -> Column:
        at = F.col(axis)
        return F.explode(F.array_distinct(F.array(*[F.floor((at + k) / size).cast("int") for k in (-1, 0, 1)])))

    tiles = grid.select("r", "c", "z").withColumn("_i", near("r")).withColumn("_j", near("c"))

    def work(t: pa.Table) -> pa.Table:
        r0, c0 = t.column("_i")[0].as_py() * size - 1, t.column("_j")[0].as_py() * size - 1
        r, c = t.column("r").to_numpy() - r0, t.column("c").to_numpy() - c0
        z, here = np.full((size + 2, size + 2), np.nan), np.zeros((size + 2, size + 2), bool)
        z[r, c], here[r, c] = t.column("z").to_numpy(zero_copy_only=False), True
        own = here[1:-1, 1:-1] & here[2:, 1:-1] & here[:-2, 1:-1] & here[1:-1, 2:] & here[1:-1, :-2]
        i, j = np.nonzero(own)
        heights = {n: z[i + 1 + dr, j + 1 + dc] for n, (dr, dc) in AROUND.items()}
        return pa.table({"r": (i + 1 + r0).astype(np.int32), "c": (j + 1 + c0).astype(np.int32)} | {n: pa.array(v, mask=np.isnan(v)) for n, v in heights.items()})

    return tiles.groupBy("_i", "_j").applyInArrow(work, "r int, c int, " + ", ".join(f"{n} double" for n in AROUND))


def horn(spacing: float = 1.0) -> tuple[Column, Column]:
    a, b, c, d, f, g, h, k = map(F.col, ("a", "b", "c_", "d", "f", "g", "h", "k"))
    return ((c + 2 * f + k) - (a + 2 * d + g)) / (8 * spacing), ((a + 2 * b + c) - (g + 2 * h + k)) / (8 * spacing)


def rook(spacing: float = 1.0) -> tuple[Column, Column]:
    """The second method: differences of the four nearest neighbours."""
    return (F.col("f") - F.col("d")) / (2 * spacing), (F.col("b") - F.col("h")) / (2 * spacing)


def laplacian(spacing: float = 1.0) -> Column:
    return (F.col("b") + F.col("d") + F.col("f") + F.col("h") - 4 * F.col("z")) / (spacing * spacing)


def slopes(grid: DataFrame, spacing: float = 1.0) -> DataFrame:
    """r, c, p, q, horn_pct, rook_pct, curvature, valid, photon of interior nodes."""
    (p, q), (pz, qz) = horn(spacing), rook(spacing)
    out = neighbours(grid).select("r", "c", p.alias("p"), q.alias("q"), slope_percent(p, q).alias("horn_pct"), slope_percent(pz, qz).alias("rook_pct"), F.abs(laplacian(spacing)).alias("curvature"))
    both = F.col("horn_pct").isNotNull() & F.col("rook_pct").isNotNull()
    return out.withColumn("valid", both).withColumn("photon", photon(F.col("horn_pct"), F.col("rook_pct"), TOL_SLOPE_PP))


def classes(grid: DataFrame, spacing: float = 1.0, slope: DataFrame | None = None) -> DataFrame:
    """r, c, cls, asp of every node; the border has no data. slope: that of the grid, if it is at hand."""
    slope = slopes(grid, spacing) if slope is None else slope
    inner = slope.select("r", "c", slope_class(F.col("horn_pct")).alias("cls"), octant(F.col("p"), F.col("q"), F.col("horn_pct")).alias("asp"))
    none = F.lit(NODATA_CLASS)
    # a sum by node instead of a join, which needs no sorting: each node comes once from the grid and once, inside, with its class
    both = inner.unionByName(grid.select("r", "c", F.lit(None).cast("int").alias("cls"), F.lit(None).cast("int").alias("asp")))
    return both.groupBy("r", "c").agg(F.coalesce(F.max("cls"), none).alias("cls"), F.coalesce(F.max("asp"), none).alias("asp"))


KERNELS = {
    "p": ((-1, 0, 1), (-2, 0, 2), (-1, 0, 1), 8),
    "q": ((-1, -2, -1), (0, 0, 0), (1, 2, 1), 8),
    "pz": ((0, 0, 0), (-1, 0, 1), (0, 0, 0), 2),
    "qz": ((0, -1, 0), (0, 0, 0), (0, 1, 0), 2),
}


def witness(grid: DataFrame, spacing: float = 1.0) -> DataFrame:
    """r, c, horn_pct, rook_pct by scattered kernels; only nodes whose nine nodes all have heights."""
    around = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr in (-1, 0, 1) for dc in (-1, 0, 1)])
    spread = grid.where("z IS NOT NULL").select("r", "c", "z", F.explode(around).alias("o"))
    weight = {n: F.create_map(*[F.lit(v) for dr in (-1, 0, 1) for dc in (-1, 0, 1) for v in (3 * dr + dc, float(k[dr + 1][dc + 1]) / (k[3] * spacing))]) for n, k in KERNELS.items()}
    place = 3 * F.col("o.dr") + F.col("o.dc")
    sums = [F.sum(F.col("z") * w[place]).alias(n) for n, w in weight.items()]
    got = spread.groupBy((F.col("r") - F.col("o.dr")).alias("r"), (F.col("c") - F.col("o.dc")).alias("c")).agg(F.count("*").alias("n"), *sums).where("n = 9")
    return got.select("r", "c", F.hypot("p", "q").alias("ph"), F.hypot("pz", "qz").alias("pr")).select("r", "c", (100.0 * F.col("ph")).alias("horn_pct"), (100.0 * F.col("pr")).alias("rook_pct"))


def exact_quantile(frame: DataFrame, column: str, q: float) -> float | None:
    """The interpolated quantile of a column's values, exactly, without gathering them: counts by bins show which bin
    holds the rank, its values are binned again until few are left or all are equal, and those are sorted."""
    values = frame.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    found = values.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n, lo, hi = found["n"], found["lo"], found["hi"]
    if not n:
        return None
    place = q * (n - 1)
    # ranks below and above the place, from 0; `below` values are smaller than those still looked at
    first, last, below = int(np.floor(place)), int(np.ceil(place)), 0
    inside = n
    between = lambda a, b: float(a) if a == b else float((last - place) * a + (place - first) * b)
    while inside > LAST_VALUES and lo < hi:
        bin_ = F.least(F.floor((F.col("v") - lo) / ((hi - lo) / BINS)), F.lit(BINS - 1)).cast("int")
        rows = values.where(F.col("v").between(lo, hi)).groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("bin").collect()
        ends = below + np.cumsum([r["n"] for r in rows])
        i, j = int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, last, "right"))
        if i < j:  # the greatest of one bin and the least of the next
            return between(rows[i]["hi"], rows[j]["lo"])
        below, lo, hi, inside = int(ends[i]) - rows[i]["n"], rows[i]["lo"], rows[i]["hi"], rows[i]["n"]
    if lo == hi:
        return lo
    rest = np.sort(np.array([r["v"] for r in values.where(F.col("v").between(lo, hi)).collect()]))
    return between(rest[first - below], rest[last - below])


def breaks(slope: DataFrame) -> DataFrame:
    """slope with cut, brk (among the top 5 % of curvature of valid nodes) and near_brk (within one node of such)."""
    cut = exact_quantile(slope.where("valid"), "curvature", 0.95)
    marked = slope.withColumn("cut", F.lit(cut).cast("double")).withColumn("brk", F.coalesce((F.col("curvature") >= F.coalesce("cut", F.lit(0.0))) & (F.col("curvature") > 1e-6), F.lit(False)))
    # rows and columns are dense, so a frame of three rows is a node and its two neighbours
    near = marked.withColumn("m", F.max("brk").over(_across().rowsBetween(-1, 1))).withColumn("m", F.max("m").over(_along().rowsBetween(-1, 1)))
    return near.withColumn("near_brk", F.col("m") & F.col("valid")).drop("m")


def shares(classes_: DataFrame, *key: str) -> DataFrame:
    """cls and its share of valid nodes, six decimals, by key; classes without nodes have share 0."""
    counts = [F.count_if(F.col("cls") == k).alias(f"n{k}") for k in range(len(SLOPE_LABELS))]
    n = classes_.groupBy(*key).agg(F.count_if(F.col("cls") != NODATA_CLASS).alias("valid"), *counts)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("cls"), F.col(f"n{k}").alias("n")) for k in range(len(SLOPE_LABELS))]))
    out = n.select(*key, "valid", each.alias("x")).select(*key, "x.cls", "x.n", "valid")
    return out.select(*key, "cls", "n", F.when(F.col("valid") > 0, F.bround(F.col("n") / F.greatest("valid", F.lit(1)), 6)).otherwise(0.0).alias("share"))


def hot_cells(photons: DataFrame, size: int = 16, top: int = 8) -> DataFrame:
    """The cells of size x size nodes with most photons; ties to the south, then west."""
    at = photons.groupBy(F.floor(F.col("r") / size).alias("cell_r"), F.floor(F.col("c") / size).alias("cell_c")).agg(F.count("*").alias("photons"))
    return at.orderBy(F.desc("photons"), "cell_r", "cell_c").limit(top)


def worst(photons: DataFrame, top: int = 8) -> DataFrame:
    """The photons with the largest difference; ties by row, then column."""
    diff = F.abs(F.col("horn_pct") - F.col("rook_pct"))
    return photons.select("r", "c", "horn_pct", "rook_pct", diff.alias("diff_pp")).orderBy(F.desc("diff_pp"), "r", "c").limit(top)


def witness_counts(slope: DataFrame, seen: DataFrame) -> DataFrame:
    """One row that holds the plans' slopes against the witness's."""
    both = slope.where("valid").select("r", "c", F.col("horn_pct").alias("h"), F.col("rook_pct").alias("z"), "photon").join(seen, ["r", "c"], "left")
    edge = F.least(*[F.abs(F.col("horn_pct") - e) for e in SLOPE_EDGES]) <= TOL_WITNESS
    flip = slope_class(F.col("h")) != slope_class(F.col("horn_pct"))
    seen_ = F.col("horn_pct").isNotNull()
    own = F.count_if(seen_ & photon(F.col("horn_pct"), F.col("rook_pct"), TOL_SLOPE_PP))
    return both.agg(
        F.count_if(seen_).alias("nodes"), F.max(F.abs(F.col("h") - F.col("horn_pct"))).alias("horn_max_diff"), F.max(F.abs(F.col("z") - F.col("rook_pct"))).alias("rook_max_diff"),
        F.count_if(seen_ & flip & ~edge).alias("class_mismatch"), F.count_if(seen_ & flip & edge).alias("edge_ties"), own.alias("photons_witness"), F.count_if("photon").alias("photons_plan"),
    )


def slope_statistics(slope: DataFrame) -> DataFrame:
    """One row: counts, means, maxima, photons and how many of them lie near breaks of slope."""
    ok = lambda c: F.when(F.col("valid"), F.col(c))
    return slope.agg(
        F.count_if("valid").alias("valid"), F.avg(ok("horn_pct")).alias("horn_mean"), F.max(ok("horn_pct")).alias("horn_max"), F.avg(ok("rook_pct")).alias("rook_mean"), F.max(ok("rook_pct")).alias("rook_max"),
        F.count_if("photon").alias("photons"), F.max(F.when(F.col("valid"), F.abs(F.col("horn_pct") - F.col("rook_pct")))).alias("max_diff_pp"),
        F.count_if(F.col("photon") & F.col("near_brk")).alias("on_breaks"), F.count_if("near_brk").alias("near_breaks"), F.max("cut").alias("curvature_p95"),
    )
