"""The registered queries of the elevation engine, one per operator, with SQL that DuckDB runs on the same tables.

The tables hold no rasters, so a surface is derived from `orders` in both engines: node (r, c) of key k is
(k // 100, k % 100), its height whole centimetres, missing for k % 997 = 5. Points come from `events`, works
from `supplier`, both by modular arithmetic. Rounded columns keep clear of the last digits of libm.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import cable, grid, terrain, verify, works
from ..sources import coverage, rasters, tiles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
COLS, TILE = 100, 8


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def surface(spark: SparkSession, d: str, relief: int = 40) -> DataFrame:
    k = F.col("o_orderkey")
    cm = 8000 + 2 * (k % COLS) + F.round(F.col("o_totalprice") * 100).cast("long") % relief
    return table(spark, d, "orders").select(F.floor(k / COLS).cast("int").alias("r"), (k % COLS).cast("int").alias("c"), F.when(k % 997 != 5, cm / 100.0).alias("z"))


def n_rows(spark: SparkSession, d: str) -> int:
    return int(surface(spark, d).agg(F.max("r")).first()[0]) + 1


def surface_sql(relief: int = 40) -> str:
    return f"s AS (SELECT (o_orderkey // 100)::INTEGER AS r, (o_orderkey % 100)::INTEGER AS c, CASE WHEN o_orderkey % 997 <> 5 THEN (8000 + 2 * (o_orderkey % 100) + round(o_totalprice * 100)::BIGINT % {relief})::DOUBLE / 1e2 END AS z FROM orders)"


STENCIL_SQL = """
row_ AS (SELECT r, c, z, lag(z) OVER a AS d, lead(z) OVER a AS f, lag(1) OVER a AS west, lead(1) OVER a AS east FROM s WINDOW a AS (PARTITION BY r ORDER BY c)),
nb AS (SELECT * FROM (SELECT r, c, z, d, f, west, east, lead(d) OVER b AS a, lead(z) OVER b AS b, lead(f) OVER b AS c_, lag(d) OVER b AS g, lag(z) OVER b AS h, lag(f) OVER b AS k, lag(1) OVER b AS south, lead(1) OVER b AS north
  FROM row_ WINDOW b AS (PARTITION BY c ORDER BY r)) WHERE west = 1 AND east = 1 AND south = 1 AND north = 1),
pq AS (SELECT r, c, ((c_ + 2 * f + k) - (a + 2 * d + g)) / 8e0 AS p, ((a + 2 * b + c_) - (g + 2 * h + k)) / 8e0 AS q, (f - d) / 2e0 AS pz, (b - h) / 2e0 AS qz, abs(b + d + f + h - 4 * z) AS curvature FROM nb),
sl AS (SELECT *, 100 * sqrt(p * p + q * q) AS horn_pct, 100 * sqrt(pz * pz + qz * qz) AS rook_pct FROM pq),
sv AS (SELECT *, horn_pct IS NOT NULL AND rook_pct IS NOT NULL AS valid, coalesce(abs(horn_pct - rook_pct) > 1.0, false) AS photon FROM sl)"""
CLASS_SQL = "CASE WHEN horn_pct IS NULL THEN 255 WHEN horn_pct >= 25 THEN 5 WHEN horn_pct >= 15 THEN 4 WHEN horn_pct >= 10 THEN 3 WHEN horn_pct >= 5 THEN 2 WHEN horn_pct >= 2 THEN 1 ELSE 0 END"
ASPECT_SQL = "CASE WHEN horn_pct IS NULL THEN 255 WHEN horn_pct < 0.5 THEN 8 ELSE (floor(fmod(degrees(atan2(-p, -q)) + 360, 360) / 45 + 0.5)::INTEGER % 8) END"
CELLS_SQL = """
c1 AS (SELECT r, c, z AS h00, lead(z) OVER a AS h10, lead(1) OVER a AS e FROM s WINDOW a AS (PARTITION BY r ORDER BY c)),
c2 AS (SELECT *, lead(h00) OVER b AS h01, lead(h10) OVER b AS h11, lead(1) OVER b AS n FROM c1 WINDOW b AS (PARTITION BY c ORDER BY r)),
cells AS (SELECT r AS i, c AS j, h00, h10, h01, h11 FROM c2 WHERE e = 1 AND n = 1)"""
TILES_SQL = f"""
ext AS (SELECT max(r) AS mr, max(c) AS mc FROM s),
ct AS (SELECT ix, iy, r - iy * {TILE} AS i, c - ix * {TILE} AS j, r, c, z FROM (
  SELECT s.*, unnest(CASE WHEN c % {TILE} = 0 THEN [c // {TILE} - 1, c // {TILE}] ELSE [c // {TILE}] END) AS ix FROM s) x
  CROSS JOIN LATERAL (SELECT unnest(CASE WHEN x.r % {TILE} = 0 THEN [x.r // {TILE} - 1, x.r // {TILE}] ELSE [x.r // {TILE}] END) AS iy) y, ext
  WHERE ix >= 0 AND iy >= 0 AND ix <= (mc + {TILE} - 1) // {TILE} - 1 AND iy <= (mr + {TILE} - 1) // {TILE} - 1),
qt AS (SELECT ix, iy, i, j, r, c, z, coalesce(min(round_even(z * 100, 0)::BIGINT) OVER (PARTITION BY ix, iy), 0) AS base_cm,
  CASE WHEN z IS NULL THEN 65535 ELSE round_even(z * 100, 0)::BIGINT - min(round_even(z * 100, 0)::BIGINT) OVER (PARTITION BY ix, iy) END AS q FROM ct)"""
#: Fractional places of events: some beyond the grid, some at nodes.
POINTS_SQL = "pts AS (SELECT event_id AS pid, (event_id * 7919 % 101000 - 1000)::DOUBLE / 1e3 AS gx, (event_id * 104729 % (1000 * (SELECT max(r) + 1 FROM s)) - 500 * (event_id % 2))::DOUBLE / 1e3 AS gy FROM events)"


def points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, d, "events").select(k.alias("pid"), ((k * 7919 % 101000 - 1000).cast("double") / 1e3).alias("gx"), ((k * 104729 % (1000 * n_rows(spark, d)) - 500 * (k % 2)).cast("double") / 1e3).alias("gy"))


def tiled(spark: SparkSession, d: str) -> DataFrame:
    return grid.quantise(grid.cut(surface(spark, d), n_rows(spark, d), COLS, TILE))


# ---------------------------------------------------------------- sources and sinks
@query("s1_coverage_url", "SELECT s_suppkey AS k, 'https://example.org/wcs?service=WCS&version=2.0.1&request=GetCoverage&CoverageId=heights_1m&format=image/tiff&subset=E(' || s_suppkey * 1000 || ',' || (s_suppkey * 1000 + 1000) || ')&subset=N(' || s_suppkey * 7 || ',' || (s_suppkey * 7 + 500) || ')' AS url FROM supplier")
def s1(spark, d):
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("k"), coverage.coverage_url("https://example.org/wcs", "heights_1m", k * 1000, k * 1000 + 1000, k * 7, k * 7 + 500).alias("url"))


@query("s2_chunk_ranges", "SELECT k, a, least(a + 1000, hi) AS b FROM (SELECT c_custkey AS k, c_custkey + c_custkey * 7 % 3700 AS hi, unnest(range(c_custkey, c_custkey + c_custkey * 7 % 3700, 1000)) AS a FROM customer)")
def s2(spark, d):
    k = F.col("c_custkey")
    return grid.chunk_ranges(table(spark, d, "customer").select(k.alias("k"), k.alias("lo"), (k + k * 7 % 3700).alias("hi"))).select("k", "a", "b")


@query("s4_chunk_plan", "SELECT k, e0, least(e0 + 1000, e_hi) AS e1, n0, least(n0 + 1000, n_hi) AS n1 FROM (SELECT *, unnest(range(n_lo, n_hi, 1000)) AS n0 FROM (SELECT *, unnest(range(e_lo, e_hi, 1000)) AS e0 FROM (SELECT s_suppkey AS k, s_suppkey * 100 AS e_lo, s_suppkey * 100 + s_suppkey * 37 % 2500 AS e_hi, s_suppkey AS n_lo, s_suppkey + s_suppkey * 53 % 3100 AS n_hi FROM supplier)))")
def s4(spark, d):
    k = F.col("s_suppkey")
    box = table(spark, d, "supplier").select(k.alias("k"), (k * 100).alias("e_lo"), (k * 100 + k * 37 % 2500).alias("e_hi"), k.alias("n_lo"), (k + k * 53 % 3100).alias("n_hi"))
    return grid.chunk_plan(box).select("k", "e0", "e1", "n0", "n1")


#: Two chunks that overlap in rows 40 to 59 and differ by a quarter metre, as float32 rasters.
MOSAIC_SQL = f"WITH {surface_sql()}, p AS (SELECT 0 AS k, r, c, z::FLOAT::DOUBLE AS z FROM s WHERE r < 60 UNION ALL SELECT 1, r, c, (z + 0.25)::FLOAT::DOUBLE FROM s WHERE r >= 40 AND c >= 10)"


def _chunk_files(spark: SparkSession, d: str) -> DataFrame:
    """The two chunks as GeoTIFF bytes, the no-data value -9999."""
    s = surface(spark, d)
    a, b = s.where("r < 60").select(F.lit(0).alias("chunk"), "r", "c", "z"), s.where("r >= 40 AND c >= 10").select(F.lit(1).alias("chunk"), "r", "c", (F.col("z") + 0.25).alias("z"))

    def work(t: pa.Table) -> pa.Table:
        r, c, z = (t.column(x).to_numpy(zero_copy_only=False) for x in ("r", "c", "z"))
        box = np.full((r.max() - r.min() + 1, c.max() - c.min() + 1), -9999.0)
        box[r - r.min(), c - c.min()] = np.where(np.isnan(z), -9999.0, z)
        return pa.table({"chunk": t.column("chunk").slice(0, 1), "content": [rasters.write_geotiff(box[::-1], 400000.0 + c.min(), 300000.0 + r.max() + 1, -9999.0)]})

    return a.unionByName(b).groupBy("chunk").applyInArrow(work, "chunk int, content binary")


@query("s5_geotiff_read", MOSAIC_SQL + " SELECT k AS chunk, r, c, z FROM p WHERE z IS NOT NULL")
def s5(spark, d):
    p = rasters.geotiff_pieces(_chunk_files(spark, d), 400000, 300000, n_rows(spark, d), COLS)
    return p.select("chunk", "r", "c", S.mask_nodata(F.col("z"), F.col("nodata")).alias("z")).where("z IS NOT NULL")


@query("s5b_raw_nodata", "SELECT p_partkey AS k, TRY_CAST(trim(CASE p_partkey % 4 WHEN 0 THEN ' -9999 ' WHEN 1 THEN 'none' WHEN 2 THEN '' ELSE p_size || '.5 ' END) AS DOUBLE) AS nodata FROM part")
def s5b(spark, d):
    k = F.col("p_partkey")
    text = F.when(k % 4 == 0, " -9999 \0").when(k % 4 == 1, "none").when(k % 4 == 2, "").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5 ")))
    return table(spark, d, "part").select(k.alias("k"), S.raw_nodata(text).alias("nodata"))


def _blobs(spark: SparkSession, d: str) -> DataFrame:
    return tiles.encode_heights(tiled(spark, d), TILE + 1)


@query("s6_height_tiles_round_trip", f"WITH {surface_sql()}, {TILES_SQL} SELECT ix, iy, i, j, q::INTEGER AS q, base_cm::INTEGER AS base_cm, CASE WHEN q <> 65535 THEN (base_cm + q) / 1e2 END AS z FROM qt")
def s6(spark, d):
    files = _blobs(spark, d).select(F.concat_ws("_", "ix", "iy").alias("path"), F.col("data").alias("content"))
    rows = tiles.decode_heights(files).select(F.split("path", "_").alias("k"), "i", "j", "q", "base_cm", "z", "origin_e_m", "origin_n_m")
    last = n_rows(spark, d) - 1
    return rows.where((F.col("origin_n_m") + F.col("i") <= last) & (F.col("origin_e_m") + F.col("j") < COLS)).select(F.col("k")[0].cast("int").alias("ix"), F.col("k")[1].cast("int").alias("iy"), "i", "j", "q", "base_cm", "z")


@query("s8_merge_tiles", MOSAIC_SQL + " SELECT s.r, s.c, arg_max({'z': p.z}, p.k).z AS z FROM s LEFT JOIN p USING (r, c) GROUP BY ALL")
def s8(spark, d):
    s = surface(spark, d)
    f = lambda x: x.cast("float").cast("double")
    p = s.where("r < 60").select(F.lit(0).alias("tile"), "r", "c", f(F.col("z")).alias("z")).unionByName(s.where("r >= 40 AND c >= 10").select(F.lit(1).alias("tile"), "r", "c", f(F.col("z") + 0.25).alias("z")))
    return grid.merge_tiles(s, p)


CUT_SQL = TILES_SQL.split("qt AS")[0].strip().rstrip(",")


@query("s9_class_tiles_round_trip", f"WITH {surface_sql(200)}, {STENCIL_SQL}, cl AS (SELECT s.r, s.c, coalesce({CLASS_SQL}, 255) AS cls, coalesce({ASPECT_SQL}, 255) AS asp, 0 AS z FROM s LEFT JOIN sl USING (r, c)), {CUT_SQL.replace('SELECT s.*', 'SELECT cl.*').replace('AS ix FROM s)', 'AS ix FROM cl)').replace(' r, c, z FROM (', ' r, c, cls, asp FROM (')} SELECT ix, iy, i, j, cls, asp, ({(TILE + 1) ** 2} - count(*) FILTER (WHERE cls <> 255) OVER w)::BIGINT AS nodata_count, (count(*) FILTER (WHERE cls >= 3 AND cls <> 255) OVER w)::BIGINT AS steep_count FROM ct WINDOW w AS (PARTITION BY ix, iy)")
def s9(spark, d):
    cut = grid.cut(terrain.classes(surface(spark, d, 200)), n_rows(spark, d), COLS, TILE)
    files = tiles.encode_classes(cut, TILE + 1).select(F.concat_ws("_", "ix", "iy").alias("path"), F.col("data").alias("content"))
    k, last = F.split("path", "_"), n_rows(spark, d) - 1
    at = tiles.decode_classes(files).withColumns({"ix": k[0].cast("int"), "iy": k[1].cast("int")})
    return at.where((F.col("iy") * TILE + F.col("i") <= last) & (F.col("ix") * TILE + F.col("j") < COLS)).select("ix", "iy", "i", "j", "cls", "asp", "nodata_count", "steep_count")


@query("s12_synthetic_grid")
def s12(spark, d):
    return rasters.synthetic(spark, 257, 257)


@query("k1_tile_summary", f"WITH {surface_sql()}, {TILES_SQL} SELECT ix, iy, any_value(base_cm)::BIGINT AS base_cm, coalesce(min(q) FILTER (WHERE q <> 65535), 0)::INTEGER AS min_q, coalesce(max(q) FILTER (WHERE q <> 65535), 0)::INTEGER AS max_q, ({(TILE + 1) ** 2} - count(*) FILTER (WHERE q <> 65535))::BIGINT AS nodata, (any_value(base_cm) + min(q) FILTER (WHERE q <> 65535)) / 1e2 AS min_m, (any_value(base_cm) + max(q) FILTER (WHERE q <> 65535)) / 1e2 AS max_m FROM qt GROUP BY ix, iy")
def k1(spark, d):
    return grid.tile_summary(tiled(spark, d), TILE + 1)


def _le(value: str, size: int) -> str:
    """The hexadecimal digits of a little-endian number in SQL."""
    return "printf('" + "%02x" * size + "', " + ", ".join(f"({value})::BIGINT >> {8 * k} & 255" for k in range(size)) + ")"


@query("k3_manifest_entries", f"WITH {surface_sql()}, {TILES_SQL}, sq AS (SELECT ix, iy, n, n // {TILE + 1} AS i, n % {TILE + 1} AS j FROM (SELECT DISTINCT ix, iy FROM qt), range({(TILE + 1) ** 2}) AS t(n)), bd AS (SELECT ix, iy, string_agg({_le('coalesce(q, 65535)', 2)}, '' ORDER BY n) AS body FROM sq LEFT JOIN qt USING (ix, iy, i, j) GROUP BY ix, iy), hd AS (SELECT ix, iy, '47474831' || {_le('1', 2)} || {_le(str(TILE + 1), 2)} || {_le('1000', 2)} || {_le('0', 2)} || {_le(f'ix * {TILE}', 4)} || {_le(f'iy * {TILE}', 4)} || {_le('any_value(base_cm)', 4)} || {_le('coalesce(min(q) FILTER (WHERE q <> 65535), 0)', 2)} || {_le('coalesce(max(q) FILTER (WHERE q <> 65535), 0)', 2)} || {_le(f'{(TILE + 1) ** 2} - count(*) FILTER (WHERE q <> 65535)', 4)} AS head FROM qt GROUP BY ix, iy) SELECT ix || '_' || iy AS key, sha256(unhex(head || body)) AS sha256, (ix * {TILE})::INTEGER AS e0, (iy * {TILE})::INTEGER AS n0, (length(head || body) // 2)::INTEGER AS bytes FROM hd JOIN bd USING (ix, iy)")
def k3(spark, d):
    b = _blobs(spark, d)
    return b.select(F.concat_ws("_", "ix", "iy").alias("key"), F.sha2("data", 256).alias("sha256"), "e0", "n0", F.length("data").alias("bytes"))


@query("k5_tile_shares", f"WITH {surface_sql(200)}, {STENCIL_SQL}, cl AS (SELECT s.r, s.c, coalesce({CLASS_SQL}, 255) AS z FROM s LEFT JOIN sl USING (r, c)), {CUT_SQL.replace('SELECT s.*', 'SELECT cl.*').replace('AS ix FROM s)', 'AS ix FROM cl)')}, n AS (SELECT ix, iy, count(*) FILTER (WHERE z <> 255) AS v FROM ct GROUP BY ix, iy) SELECT ix, iy, k::INTEGER AS cls, count(*) FILTER (WHERE z = k)::BIGINT AS n, CASE WHEN any_value(v) > 0 THEN round_even(count(*) FILTER (WHERE z = k) / greatest(any_value(v), 1)::DOUBLE, 6) ELSE 0 END AS share FROM n JOIN ct USING (ix, iy), (VALUES (0), (1), (2), (3), (4), (5)) AS x(k) GROUP BY ix, iy, k")
def k5(spark, d):
    cut = grid.cut(terrain.classes(surface(spark, d, 200)), n_rows(spark, d), COLS, TILE)
    return terrain.shares(cut, "ix", "iy").select("ix", "iy", "cls", "n", "share")


# ---------------------------------------------------------------- projections
@query("p1_snapped_box", "SELECT c_custkey AS k, (floor((c_acctbal * 100 - 1024) / 256 + 0.5) * 256)::BIGINT AS e0, (floor((c_custkey * 301 - 1024) / 256.0::DOUBLE + 0.5) * 256)::BIGINT AS n0 FROM customer")
def p1(spark, d):
    t = table(spark, d, "customer")
    return t.select(F.col("c_custkey").alias("k"), S.snapped(F.col("c_acctbal") * 100, F.lit(2048)).alias("e0"), S.snapped(F.col("c_custkey") * 301, F.lit(2048)).alias("n0"))


@query("p2_mask_nodata", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 IN (0, 1, 2, 3) OR (o_orderkey % 11 = 4) THEN NULL ELSE o_totalprice END AS z FROM orders")
def p2(spark, d):
    k = F.col("o_orderkey")
    raw = F.when(k % 11 == 0, float("nan")).when(k % 11 == 1, float("inf")).when(k % 11 == 2, -3.4028e38).when(k % 11 == 3, -1000.5).when(k % 11 == 4, -500.0004).otherwise(F.col("o_totalprice"))
    return table(spark, d, "orders").select(k.alias("k"), S.mask_nodata(raw, F.lit(-500.0)).alias("z"))


@query("p3_dequantise", f"WITH {surface_sql()}, {TILES_SQL} SELECT ix, iy, i, j, CASE WHEN q <> 65535 THEN (base_cm + q) / 1e2 END AS h, 400000.0::DOUBLE + (ix * {TILE} + j) * 0.5::DOUBLE AS e FROM qt")
def p3(spark, d):
    return tiled(spark, d).select("ix", "iy", "i", "j", S.dequantise(F.col("base_cm"), F.col("q")).alias("h"), S.node(F.lit(400000.0), F.col("ix") * TILE + F.col("j"), F.lit(0.5)).alias("e"))


@query("p7_class_aspect_histogram", f"WITH {surface_sql(200)}, {STENCIL_SQL} SELECT {CLASS_SQL} AS cls, {ASPECT_SQL} AS asp, count(*) AS n, round(sum(horn_pct), 3) AS total_pct FROM sl GROUP BY 1, 2")
def p7(spark, d):
    s = terrain.slopes(surface(spark, d, 200))
    return s.groupBy(S.slope_class(F.col("horn_pct")).alias("cls"), S.octant(F.col("p"), F.col("q"), F.col("horn_pct")).alias("asp")).agg(F.count("*").alias("n"), F.round(F.sum("horn_pct"), 3).alias("total_pct"))


@query("p9_disagreement", "SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, round(abs(l_quantity - l_discount * 500) / greatest(l_quantity, l_discount * 500, 1e-12), 9) AS rel, abs(l_quantity - l_discount * 500) / greatest(l_quantity, l_discount * 500, 1e-12) > 0.005 AS photon FROM lineitem")
def p9(spark, d):
    rel = S.disagreement(F.col("l_quantity"), F.col("l_discount") * 500)
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.round(rel, 9).alias("rel"), (rel > S.TOL_VOLUME).alias("photon"))


@query("p10_arc_point", "WITH a AS (SELECT event_id AS k, (event_id % 628) / 1e2 AS h, CASE WHEN event_id % 3 = 0 THEN 0 ELSE ((event_id % 41) - 20) / 1e2 END AS kap, (event_id % 97) / 1e1 AS u FROM events), b AS (SELECT *, kap * u / 2 AS half FROM a), c AS (SELECT *, CASE WHEN half = 0 THEN u ELSE u * sin(half) / half END AS ch FROM b) SELECT k, round(10 + ch * cos(h + half), 6) AS x, round(20 + ch * sin(h + half), 6) AS y FROM c")
def p10(spark, d):
    k = F.col("event_id")
    x, y = S.arc_point(F.lit(10.0), F.lit(20.0), (k % 628) / 1e2, F.when(k % 3 == 0, 0.0).otherwise((k % 41 - 20) / 1e2), (k % 97) / 1e1)
    return table(spark, d, "events").select(k.alias("k"), F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


TRENCH_SQL = """tr AS (SELECT s_suppkey AS tid, 20 + (s_suppkey * 7 % 50)::DOUBLE AS e0, 25 + (s_suppkey * 11 % 60)::DOUBLE AS n0, (s_suppkey * 37 % 628) / 1e2 AS h, 5 + (s_suppkey % 9)::DOUBLE AS l1, ((s_suppkey % 5) - 2) * 0.4::DOUBLE AS theta,
  CASE WHEN s_suppkey % 5 = 2 THEN 0 ELSE 8 + (s_suppkey % 3)::DOUBLE END AS radius, CASE WHEN s_suppkey % 5 = 2 THEN 0 ELSE 4 + (s_suppkey % 7)::DOUBLE END AS l2, [0.3, 0.45, 0.6, 0.9, 1.2][1 + s_suppkey % 5]::DOUBLE AS width, 0.6::DOUBLE + (s_suppkey % 14) / 1e1 AS depth FROM supplier),
g1 AS (SELECT *, e0 AS ax, n0 AS ay, sign(theta) AS sg, abs(theta) AS th, CASE WHEN theta <> 0 THEN radius * abs(theta) ELSE 0 END AS la, h + theta AS h2, e0 + l1 * cos(h) AS bx, n0 + l1 * sin(h) AS by_ FROM tr),
g2 AS (SELECT *, bx - sin(h) * sg * radius AS cx, by_ + cos(h) * sg * radius AS cy FROM g1),
g AS (SELECT *, CASE WHEN sg <> 0 THEN cx + sin(h2) * sg * radius ELSE bx END AS dx, CASE WHEN sg <> 0 THEN cy - cos(h2) * sg * radius ELSE by_ END AS dy, l1 + la + l2 AS length FROM g2)"""


def trenches(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    straight = k % 5 == 2
    width = F.get(F.array(*map(F.lit, (0.3, 0.45, 0.6, 0.9, 1.2))), (k % 5).cast("int"))
    return table(spark, d, "supplier").select(
        k.alias("tid"), (20 + k * 7 % 50).cast("double").alias("e0"), (25 + k * 11 % 60).cast("double").alias("n0"), ((k * 37 % 628) / 1e2).alias("heading"), (5 + k % 9).cast("double").alias("l1"), ((k % 5 - 2) * 0.4).alias("theta"),
        F.when(straight, 0.0).otherwise((8 + k % 3).cast("double")).alias("radius"), F.when(straight, 0.0).otherwise((4 + k % 7).cast("double")).alias("l2"), width.alias("width"), (0.6 + (k % 14) / 1e1).alias("depth"),
    )


@query("p12_trench_geometry", f"WITH {TRENCH_SQL} SELECT tid, round(bx, 6) AS bx, round(by_, 6) AS \"by\", round(cx, 6) AS cx, round(cy, 6) AS cy, round(dx, 6) AS dx, round(dy, 6) AS dy, round(h2, 6) AS h2, round(la, 6) AS la, round(length, 6) AS length FROM g")
def p12(spark, d):
    return works.trench_geometry(trenches(spark, d)).select("tid", *[F.round(x, 6).alias(x) for x in ("bx", "by", "cx", "cy", "dx", "dy", "h2", "la", "length")])


@query("p11_centreline", f"WITH {TRENCH_SQL}, at AS (SELECT g.*, n, length * n / 7e0 + 0.01 AS s FROM g, range(7) AS t(n)), w AS (SELECT *, CASE WHEN s <= l1 THEN 0 WHEN s <= l1 + la THEN 1 ELSE 2 END AS piece FROM at), v AS (SELECT *, s - CASE WHEN piece >= 1 THEN l1 ELSE 0 END - CASE WHEN piece = 2 THEN la ELSE 0 END AS u FROM w), hh AS (SELECT *, CASE piece WHEN 0 THEN h WHEN 1 THEN h + sg * u / radius ELSE h2 END AS a FROM v) SELECT tid, n::INTEGER AS n, piece, round(CASE piece WHEN 0 THEN ax + u * cos(a) WHEN 1 THEN cx + sin(a) * sg * radius ELSE dx + u * cos(a) END, 6) AS x, round(CASE piece WHEN 0 THEN ay + u * sin(a) WHEN 1 THEN cy - cos(a) * sg * radius ELSE dy + u * sin(a) END, 6) AS y, round(CASE WHEN piece = 1 THEN sg / radius ELSE 0 END, 9) AS curvature FROM hh".replace(", at AS", ", at_ AS").replace("FROM at)", "FROM at_)"))
def p11(spark, d):
    g = works.trench_geometry(trenches(spark, d)).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(6)))).withColumn("s", F.col("length") * F.col("n") / 7.0 + 0.01)
    c = works.centreline(F.col("s"))
    return g.select("tid", "n", c["piece"].alias("piece"), F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"), F.round(c["curvature"], 9).alias("curvature"))


@query("p14_arc_length", "SELECT event_id AS k, round(((event_id % 401 - 200) / 1e2 * sqrt(1 + (event_id % 401 - 200) / 1e2 * (event_id % 401 - 200) / 1e2) + asinh((event_id % 401 - 200) / 1e2)) / 2, 8) AS f FROM events")
def p14(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("k"), F.round(S.arc_length_integral((F.col("event_id") % 401 - 200) / 1e2), 8).alias("f"))


@query("p19_alias_pick", "SELECT user_id AS k, coalesce(CASE WHEN event_id % 3 = 0 THEN value END, CASE WHEN event_id % 5 = 0 THEN event_id::DOUBLE END, 1.0::DOUBLE) AS spacing, event_id AS e FROM events")
def p19(spark, d):
    k = F.col("event_id")
    return table(spark, d, "events").select(F.col("user_id").alias("k"), S.pick(F.when(k % 3 == 0, F.col("value")), F.when(k % 5 == 0, k.cast("double")), F.lit(1.0)).alias("spacing"), k.alias("e"))


# ---------------------------------------------------------------- joins
@query("j1_mosaic", MOSAIC_SQL + " SELECT s.r, s.c, arg_min(p.z, p.k) FILTER (WHERE p.z IS NOT NULL) AS z FROM s LEFT JOIN p USING (r, c) GROUP BY s.r, s.c")
def j1(spark, d):
    p = rasters.geotiff_pieces(_chunk_files(spark, d), 400000, 300000, n_rows(spark, d), COLS)
    return grid.mosaic(surface(spark, d), p.withColumn("z", S.mask_nodata(F.col("z"), F.col("nodata"))))


@query("j2_cut", f"WITH {surface_sql()}, {TILES_SQL} SELECT ix, iy, i, j, z FROM ct")
def j2(spark, d):
    return grid.cut(surface(spark, d), n_rows(spark, d), COLS, TILE).select("ix", "iy", "i", "j", "z")


def _headed(spark: SparkSession, d: str, spoil: bool = True) -> tuple[DataFrame, DataFrame]:
    """Samples and headers of tiles; one height in 101 is off by a centimetre, one header in 3 counts wrongly."""
    t = tiled(spark, d).withColumn("tile", F.col("iy") * 1000 + F.col("ix"))
    q = F.when((F.col("q") != S.NODATA_Q) & ((F.col("tile") + F.col("i") * 7 + F.col("j")) % 101 == 0), F.col("q") + 1).otherwise(F.col("q")) if spoil else F.col("q")
    t = t.select("tile", "i", "j", q.cast("int").alias("q"), F.col("base_cm").cast("long"), (F.col("ix") * TILE).alias("oe"), (F.col("iy") * TILE).alias("on"), F.lit(1.0).alias("spacing"))
    v = F.col("q") != S.NODATA_Q
    h = t.groupBy("tile", "oe", "on").agg(F.min(F.when(v, F.col("q"))).alias("min_q"), F.max(F.when(v, F.col("q"))).alias("max_q"), F.count_if(~v).alias("nodata_count"))
    return t, h.select("tile", "oe", "on", F.lit(1.0).alias("spacing"), F.lit(TILE + 1).alias("samples"), "min_q", "max_q", (F.col("nodata_count") + F.when(F.col("tile") % 3 == 0, 1).otherwise(0)).alias("nodata_count"))


HEADED_SQL = f"WITH {surface_sql()}, {TILES_SQL}, t AS (SELECT iy * 1000 + ix AS tile, ix, iy, i, j, base_cm, CASE WHEN q <> 65535 AND (iy * 1000 + ix + i * 7 + j) % 101 = 0 THEN q + 1 ELSE q END AS q FROM qt)"


@query("j3_neighbour_tiles", f"WITH {surface_sql()}, {TILES_SQL}, t AS (SELECT DISTINCT ix, iy FROM qt) SELECT (a.iy * 1000 + a.ix) AS a, (b.iy * 1000 + b.ix) AS b, CASE WHEN b.ix > a.ix THEN 'east' ELSE 'north' END AS side FROM t a JOIN t b ON (b.ix = a.ix + 1 AND b.iy = a.iy) OR (b.ix = a.ix AND b.iy = a.iy + 1)")
def j3(spark, d):
    return verify.neighbour_tiles(_headed(spark, d)[1], TILE + 1)


EDGE_SQL = HEADED_SQL + f", cm AS (SELECT *, CASE WHEN q <> 65535 THEN base_cm + q END AS cm FROM t), e AS (SELECT a.tile AS a, b.tile AS b, 'east' AS side, a.i AS sample, a.cm AS a_cm, b.cm AS b_cm FROM cm a JOIN cm b ON b.ix = a.ix + 1 AND b.iy = a.iy AND a.j = {TILE} AND b.j = 0 AND a.i = b.i UNION ALL SELECT a.tile, b.tile, 'north', a.j, a.cm, b.cm FROM cm a JOIN cm b ON b.ix = a.ix AND b.iy = a.iy + 1 AND a.i = {TILE} AND b.i = 0 AND a.j = b.j)"


@query("j4_edge_samples", EDGE_SQL + " SELECT a, b, side, sample, a_cm, b_cm, a_cm IS DISTINCT FROM b_cm AS differs FROM e")
def j4(spark, d):
    t, h = _headed(spark, d)
    return verify.edge_samples(t, verify.neighbour_tiles(h, TILE + 1), TILE + 1)


@query("t7_edge_cases", EDGE_SQL + ", n AS (SELECT *, row_number() OVER (PARTITION BY a, side ORDER BY sample) AS k FROM e WHERE a_cm IS DISTINCT FROM b_cm) SELECT a, b, side, sample, a_cm, b_cm, true AS differs FROM n WHERE k <= 8 ORDER BY a, side, sample LIMIT 8")
def t7(spark, d):
    return verify.edge_cases(j4(spark, d))


@query("p18_header_photons", HEADED_SQL + ", h AS (SELECT tile, min(q) FILTER (WHERE q <> 65535) AS lo, max(q) FILTER (WHERE q <> 65535) AS hi, count(*) FILTER (WHERE q = 65535) AS nd FROM t GROUP BY tile) SELECT tile, lo::INTEGER AS body_min, hi::INTEGER AS body_max, nd AS body_nodata, nd + 1 AS nodata_count FROM h WHERE tile % 3 = 0")
def p18(spark, d):
    return verify.header_photons(*_headed(spark, d), TILE + 1).select("tile", "body_min", "body_max", "body_nodata", "nodata_count")


@query("j5_samples_against_source", HEADED_SQL + " SELECT count(*) AS samples, count(*) FILTER (WHERE q = 65535 AND z IS NULL) AS nodata_both, count(*) FILTER (WHERE (q = 65535) <> (z IS NULL)) AS nodata_mismatch, count(*) FILTER (WHERE (q = 65535) <> (z IS NULL) OR abs((base_cm + q) / 1e2 - z) > 0.005 + 1e-9) AS photons, round(max(abs((base_cm + q) / 1e2 - z)) FILTER (WHERE q <> 65535), 6) AS max_err_m FROM t JOIN (SELECT ix, iy, i, j, z FROM ct) USING (ix, iy, i, j)")
def j5(spark, d):
    t, _ = _headed(spark, d)
    got = verify.sample_counts(verify.sample_heights(t, grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS, (0.0, 0.0)))
    return got.withColumn("max_err_m", F.round("max_err_m", 6))


@query("j6_tile_points", f"WITH {surface_sql()}, {TILES_SQL}, hq AS (SELECT ix, iy, i, j, CASE WHEN q <> 65535 THEN (base_cm + q) / 1e2 END AS h FROM qt), p AS (SELECT event_id AS pid, event_id % 13 AS ix, event_id % (SELECT max(iy) + 1 FROM qt) AS iy, (event_id * 7919 % {TILE * 1000})::DOUBLE / 1e3 AS u, (event_id * 104729 % {TILE * 1000})::DOUBLE / 1e3 AS v FROM events), a AS (SELECT *, least(floor(u), {TILE - 1})::INTEGER AS j, least(floor(v), {TILE - 1})::INTEGER AS i, u - least(floor(u), {TILE - 1}) AS fx, v - least(floor(v), {TILE - 1}) AS fy FROM p), x AS (SELECT a.pid, fx, fy, h00.h AS h00, h10.h AS h10, h01.h AS h01, h11.h AS h11 FROM a LEFT JOIN hq h00 ON h00.ix = a.ix AND h00.iy = a.iy AND h00.i = a.i AND h00.j = a.j LEFT JOIN hq h10 ON h10.ix = a.ix AND h10.iy = a.iy AND h10.i = a.i AND h10.j = a.j + 1 LEFT JOIN hq h01 ON h01.ix = a.ix AND h01.iy = a.iy AND h01.i = a.i + 1 AND h01.j = a.j LEFT JOIN hq h11 ON h11.ix = a.ix AND h11.iy = a.iy AND h11.i = a.i + 1 AND h11.j = a.j + 1) SELECT pid, round((h00 + (h10 - h00) * fx) + ((h01 + (h11 - h01) * fx) - (h00 + (h10 - h00) * fx)) * fy, 9) AS h_lerp, round(h00 + (h10 - h00) * fx + (h01 - h00) * fy + (h11 - h10 - h01 + h00) * fx * fy, 9) AS h_poly, round(h00 * (1 - fx) * (1 - fy) + h10 * fx * (1 - fy) + h01 * (1 - fx) * fy + h11 * fx * fy, 9) AS h_weights FROM x")
def j6(spark, d):
    t, _ = _headed(spark, d, spoil=False)
    return _tile_points(spark, d, t).select("pid", *[F.round(x, 9).alias(x) for x in ("h_lerp", "h_poly", "h_weights")])


def _tile_points(spark: SparkSession, d: str, t: DataFrame) -> DataFrame:
    k = F.col("event_id")
    bands = -(-(n_rows(spark, d) - 1) // TILE)
    p = table(spark, d, "events").select(k.alias("pid"), (k % bands * 1000 + k % 13).cast("int").alias("tile"), ((k * 7919 % (TILE * 1000)).cast("double") / 1e3).alias("u"), ((k * 104729 % (TILE * 1000)).cast("double") / 1e3).alias("v"))
    return verify.point_heights(p, verify.tile_cells(t), t.where("i = 0 AND j = 0"), grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS, (0.0, 0.0), samples=TILE + 1)


#: Points in spoilt tiles (pt_: three heights in the tile), and the source's height there (src).
CHECK_SQL = HEADED_SQL + f""", hq AS (SELECT ix, iy, i, j, CASE WHEN q <> 65535 THEN (base_cm + q) / 1e2 END AS h FROM t),
{CELLS_SQL}, p AS (SELECT event_id AS pid, event_id % 13 AS ix, event_id % (SELECT max(iy) + 1 FROM qt) AS iy, (event_id * 7919 % {TILE * 1000})::DOUBLE / 1e3 AS u, (event_id * 104729 % {TILE * 1000})::DOUBLE / 1e3 AS v FROM events),
a AS (SELECT *, least(floor(u), {TILE - 1})::INTEGER AS j, least(floor(v), {TILE - 1})::INTEGER AS i, u - least(floor(u), {TILE - 1}) AS fx, v - least(floor(v), {TILE - 1}) AS fy FROM p),
x AS (SELECT a.*, h00.h AS h00, h10.h AS h10, h01.h AS h01, h11.h AS h11 FROM a LEFT JOIN hq h00 ON h00.ix = a.ix AND h00.iy = a.iy AND h00.i = a.i AND h00.j = a.j LEFT JOIN hq h10 ON h10.ix = a.ix AND h10.iy = a.iy AND h10.i = a.i AND h10.j = a.j + 1 LEFT JOIN hq h01 ON h01.ix = a.ix AND h01.iy = a.iy AND h01.i = a.i + 1 AND h01.j = a.j LEFT JOIN hq h11 ON h11.ix = a.ix AND h11.iy = a.iy AND h11.i = a.i + 1 AND h11.j = a.j + 1),
pt_ AS (SELECT pid, ix, iy, iy * 1000 + ix AS tile, ix * {TILE} + u AS gx, iy * {TILE} + v AS gy, (h00 + (h10 - h00) * fx) + ((h01 + (h11 - h01) * fx) - (h00 + (h10 - h00) * fx)) * fy AS l, h00 + (h10 - h00) * fx + (h01 - h00) * fy + (h11 - h10 - h01 + h00) * fx * fy AS y, h00 * (1 - fx) * (1 - fy) + h10 * fx * (1 - fy) + h01 * (1 - fx) * fy + h11 * fx * fy AS w FROM x),
mr AS (SELECT max(r) AS mr FROM s),
b1 AS (SELECT pt_.*, least(greatest(floor(gx), 0), 98)::INTEGER AS j, least(greatest(floor(gy), 0), mr - 1)::INTEGER AS i, gx BETWEEN 0 AND 99 AND gy BETWEEN 0 AND mr AS inside FROM pt_, mr),
b2 AS (SELECT b1.*, h00, h10, h01, h11, least(greatest(gx - j, 0), 1) AS fx, least(greatest(gy - i, 0), 1) AS fy FROM b1 LEFT JOIN cells USING (i, j)),
b3 AS (SELECT *, CASE WHEN fx = 0 THEN h00 WHEN fx = 1 THEN h10 ELSE h00 + (h10 - h00) * fx END AS lo, CASE WHEN fx = 0 THEN h01 WHEN fx = 1 THEN h11 ELSE h01 + (h11 - h01) * fx END AS hi FROM b2),
src AS (SELECT *, CASE WHEN inside THEN CASE WHEN fy = 0 THEN lo WHEN fy = 1 THEN hi ELSE lo + (hi - lo) * fy END END AS g FROM b3)"""


@query("j21_point_counts", CHECK_SQL + " SELECT count(*) AS points, count(*) FILTER (WHERE l IS NULL) AS nodata_cells, count(*) FILTER (WHERE g IS NULL AND l IS NOT NULL) AS outside_source, count(*) FILTER (WHERE abs(l - y) > 1e-9) AS pair_photons, round(max(abs(l - y)), 6) AS pair_max_m, count(*) FILTER (WHERE abs(l - g) > 0.005 + 1e-9) AS source_photons, round(max(abs(l - g)), 6) AS source_max_m, count(*) FILTER (WHERE abs(l - w) > 1e-9 OR (l IS NULL) <> (w IS NULL)) AS witness_photons, round(max(abs(l - w)), 6) AS witness_max_m FROM src")
def j21(spark, d):
    return verify.point_counts(_tile_points(spark, d, _headed(spark, d)[0])).withColumns({x: F.round(x, 6) for x in ("pair_max_m", "source_max_m", "witness_max_m")})


@query("t8_check_points", CHECK_SQL + " SELECT pid, round_even(gx, 3) AS x, round_even(gy, 3) AS y, round_even(l, 9) AS h, tile::INTEGER AS tile FROM pt_ WHERE l IS NOT NULL ORDER BY pid LIMIT 16")
def t8(spark, d):
    return verify.check_points(_tile_points(spark, d, _headed(spark, d)[0]))


@query("j7_height_inside", f"WITH {surface_sql()}, {CELLS_SQL}, {POINTS_SQL}, ext AS (SELECT max(r) AS mr FROM s), a AS (SELECT *, least(greatest(floor(gx), 0), 98)::INTEGER AS j, least(greatest(floor(gy), 0), mr - 1)::INTEGER AS i, gx BETWEEN 0 AND 99 AND gy BETWEEN 0 AND mr AS inside FROM pts, ext), f AS (SELECT a.*, h00, h10, h01, h11, least(greatest(gx - j, 0), 1) AS fx, least(greatest(gy - i, 0), 1) AS fy FROM a LEFT JOIN cells USING (i, j)), l AS (SELECT *, CASE WHEN fx = 0 THEN h00 WHEN fx = 1 THEN h10 ELSE h00 + (h10 - h00) * fx END AS lo, CASE WHEN fx = 0 THEN h01 WHEN fx = 1 THEN h11 ELSE h01 + (h11 - h01) * fx END AS hi FROM f) SELECT pid, round(CASE WHEN inside THEN CASE WHEN fy = 0 THEN lo WHEN fy = 1 THEN hi ELSE lo + (hi - lo) * fy END END, 9) AS h FROM l")
def j7(spark, d):
    return grid.height_inside(points(spark, d), grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS).select("pid", F.round("h", 9).alias("h"))


GROUND_SQL = "least(greatest(floor({x}), 0), 98)::INTEGER AS j, least(greatest(floor({y}), 0), (SELECT max(r) FROM s) - 1)::INTEGER AS i"
LERP_SQL = "(h00 + (h10 - h00) * ({x} - j)) + ((h01 + (h11 - h01) * ({x} - j)) - (h00 + (h10 - h00) * ({x} - j))) * ({y} - i)"


@query("j8_ground_height", f"WITH {surface_sql()}, {CELLS_SQL}, {POINTS_SQL}, a AS (SELECT *, {GROUND_SQL.format(x='gx', y='gy')} FROM pts) SELECT pid, round({LERP_SQL.format(x='gx', y='gy')}, 9) AS h FROM a LEFT JOIN cells USING (i, j)")
def j8(spark, d):
    p = points(spark, d).withColumnsRenamed({"gx": "x", "gy": "y"})
    return grid.ground_height(p, grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS).select("pid", F.round("h", 9).alias("h"))


#: The pieces of trenches, and the cells near them.
PIECES_SQL = "pcs AS (SELECT tid, 0 AS slot, width, depth, ax AS x, ay AS y, h, 0.0::DOUBLE AS k, l1 AS len FROM g UNION ALL SELECT tid, 1, width, depth, bx, by_, h, sg / radius, la FROM g WHERE la > 0 UNION ALL SELECT tid, 2, width, depth, dx, dy, h2, 0.0, l2 FROM g WHERE l2 > 0)"
NEAR_SQL = f"{PIECES_SQL}, bx AS (SELECT *, unnest(range(floor(x - len - 2)::BIGINT, floor(x + len + 3)::BIGINT)) AS ix FROM pcs), bxy AS (SELECT *, unnest(range(floor(y - len - 2)::BIGINT, floor(y + len + 3)::BIGINT)) AS iy FROM bx), lo AS (SELECT *, (ix + 0.5 - x) * cos(h) + (iy + 0.5 - y) * sin(h) AS al, (iy + 0.5 - y) * cos(h) - (ix + 0.5 - x) * sin(h) AS off FROM bxy), tu AS (SELECT *, least(greatest(atan2(al, 1 / abs(k) - sign(k) * off), 0), len * abs(k)) AS turn FROM lo), di AS (SELECT *, CASE WHEN k = 0 THEN sqrt(power(al - least(greatest(al, 0), len), 2) + off * off) ELSE sqrt(power(al - sin(turn) / abs(k), 2) + power(sign(k) * off - 1 / abs(k) + cos(turn) / abs(k), 2)) END AS far FROM tu), near AS (SELECT DISTINCT tid, ix, iy FROM di WHERE far <= width / 2 + 0.7072)"


@query("j11_near_cells", f"WITH {TRENCH_SQL}, {NEAR_SQL} SELECT tid, count(*) AS n, sum(ix)::BIGINT AS sx, sum(iy)::BIGINT AS sy FROM near GROUP BY tid")
def j11(spark, d):
    n = works.near_cells(works.trench_geometry(trenches(spark, d)))
    return n.groupBy("tid").agg(F.count("*").alias("n"), F.sum("ix").alias("sx"), F.sum("iy").alias("sy"))


@query("j12_claim", f"WITH {TRENCH_SQL}, e AS (SELECT event_id AS pid, event_id % (SELECT count(*) FROM supplier) AS tid, (event_id * 7919 % 20000) / 1e3 AS ox, (event_id * 104729 % 20000) / 1e3 AS oy FROM events), p AS (SELECT pid, g.*, ax + ox - 10 AS x, ay + oy - 10 AS y FROM e JOIN g USING (tid)), q AS (SELECT *, (x - ax) * cos(h) + (y - ay) * sin(h) AS s1, cos(h) * (y - ay) - sin(h) * (x - ax) AS t1, (x - dx) * cos(h2) + (y - dy) * sin(h2) AS s2, cos(h2) * (y - dy) - sin(h2) * (x - dx) AS t2, x - cx AS vx, y - cy AS vy, bx - cx AS wx, by_ - cy AS wy FROM p), z AS (SELECT *, s1 BETWEEN 0 AND l1 AND abs(t1) <= width / 2 AS in1, s2 BETWEEN 0 AND l2 AND abs(t2) <= width / 2 AS in2, sqrt(vx * vx + vy * vy) AS rr, atan2(wx * vy - wy * vx, wx * vx + wy * vy) * sg AS turn FROM q), y AS (SELECT *, sg <> 0 AND turn BETWEEN 0 AND th AND abs(radius - rr) <= width / 2 AS inb FROM z) SELECT pid, in1 OR in2 OR inb AS inside, round(CASE WHEN in1 THEN ax + s1 * cos(h) WHEN in2 THEN dx + s2 * cos(h2) WHEN inb THEN cx + vx * radius / rr END, 6) AS foot_x, round(CASE WHEN in1 THEN ay + s1 * sin(h) WHEN in2 THEN dy + s2 * sin(h2) WHEN inb THEN cy + vy * radius / rr END, 6) AS foot_y FROM y")
def j12(spark, d):
    n = table(spark, d, "supplier").count()
    k = F.col("event_id")
    e = table(spark, d, "events").select(k.alias("pid"), (k % n).alias("tid"), ((k * 7919 % 20000) / 1e3).alias("ox"), ((k * 104729 % 20000) / 1e3).alias("oy"))
    p = e.join(works.trench_geometry(trenches(spark, d)), "tid").withColumn("x", F.col("ax") + F.col("ox") - 10).withColumn("y", F.col("ay") + F.col("oy") - 10)
    c = works.claim(F.col("x"), F.col("y"))
    return p.select("pid", c["inside"].alias("inside"), F.round(c["foot_x"], 6).alias("foot_x"), F.round(c["foot_y"], 6).alias("foot_y"))


#: A polygon with a bay, its first edge along x.
SHAPE = [(20.0, 20.0), (70.0, 20.0), (70.0, 60.0), (45.0, 30.5), (20.0, 55.0)]
SHAPE_SQL = "ed(x1, y1, x2, y2) AS (VALUES {})".format(", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for a, b in zip(SHAPE, [SHAPE[-1], *SHAPE[:-1]], strict=True)))


@query("j13_in_polygon", f"WITH {surface_sql()}, {POINTS_SQL}, {SHAPE_SQL} SELECT pid, count(*) FILTER (WHERE y1 <> y2 AND (y1 > gy) <> (y2 > gy) AND gx < x1 + (gy - y1) * ((x2 - x1) / nullif(y2 - y1, 0))) % 2 = 1 AS inside FROM pts, ed GROUP BY pid")
def j13(spark, d):
    return points(spark, d).select("pid", works.in_polygon(F.col("gx"), F.col("gy"), works.polygon_literal(SHAPE)).alias("inside"))


@query("j14_section_hits", f"WITH {SHAPE_SQL}, s AS (SELECT event_id AS k, (event_id * 7919 % 100000) / 1e3 AS s FROM events), h AS (SELECT k, y1 + (s - x1) * ((y2 - y1) / nullif(x2 - x1, 0)) AS t FROM s, ed WHERE x1 <> x2 AND (x1 > s) <> (x2 > s)), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t) AS n FROM h) SELECT a.k, ((a.n - 1) // 2)::INTEGER AS pair, round(a.t, 6) AS a, round(b.t, 6) AS b FROM n a JOIN n b ON b.k = a.k AND b.n = a.n + 1 WHERE a.n % 2 = 1")
def j14(spark, d):
    k = F.col("event_id")
    e = table(spark, d, "events").select(k.alias("k"), F.posexplode(works.section_hits((k * 7919 % 100000) / 1e3, works.polygon_literal(SHAPE))).alias("pair", "h"))
    return e.select("k", "pair", F.round("h.a", 6).alias("a"), F.round("h.b", 6).alias("b"))


STRAIGHT_SQL = "st AS (SELECT s_suppkey AS rid, 10 + (s_suppkey * 7 % 30)::DOUBLE AS x0, 12 + (s_suppkey * 11 % 40)::DOUBLE AS y0, (s_suppkey * 13 % 157) / 1e2 AS h0, 3 + (s_suppkey * 17 % 29)::DOUBLE + 0.25 AS len FROM supplier)"


def straights(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    t = table(spark, d, "supplier").select(k.alias("rid"), (10 + k * 7 % 30).cast("double").alias("x0"), (12 + k * 11 % 40).cast("double").alias("y0"), ((k * 13 % 157) / 1e2).alias("h0"), (3.25 + k * 17 % 29).alias("len"))
    zero = F.lit(0.0)
    return t.select("rid", "x0", "y0", "h0", F.array("len", zero, zero, zero, zero).alias("legs"), F.array(zero, zero, zero, zero).alias("turns"), F.lit(3.0).alias("radius"), F.lit(0.9).alias("depth"), F.lit(33).alias("kv"))


#: Routes with up to four bends, some too tight for their legs; two voltages.
BENT_SQL = "rt AS (SELECT s_suppkey AS rid, 20.37::DOUBLE + s_suppkey * 7 % 30 AS x0, 22.41::DOUBLE + s_suppkey * 11 % 40 AS y0, (s_suppkey * 13 % 157) / 1e2 AS h0, {legs}, {turns}, 1.4::DOUBLE + s_suppkey % 3 AS radius, 0.9::DOUBLE AS depth, CASE WHEN s_suppkey % 2 = 0 THEN 33 ELSE 132 END AS kv FROM supplier)".format(
    legs=", ".join(f"2.25::DOUBLE + s_suppkey * {p} % 17 AS l{k}" for k, p in enumerate((3, 5, 7, 11, 13))), turns=", ".join(f"(s_suppkey * {p} % 9 - 4) * 0.3::DOUBLE AS t{k}" for k, p in enumerate((3, 5, 7, 11), 1))
)


def bent(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    legs, turns = F.array(*[2.25 + k * p % 17 for p in (3, 5, 7, 11, 13)]), F.array(*[(k * p % 9 - 4) * 0.3 for p in (3, 5, 7, 11)])
    return table(spark, d, "supplier").select(k.alias("rid"), (20.37 + k * 7 % 30).alias("x0"), (22.41 + k * 11 % 40).alias("y0"), ((k * 13 % 157) / 1e2).alias("h0"), legs.alias("legs"), turns.alias("turns"), (1.4 + k % 3).alias("radius"), F.lit(0.9).alias("depth"), F.when(k % 2 == 0, 33).otherwise(132).alias("kv"))


def _plan_sql() -> str:
    """pc: the pieces of the routes rt (slot, x, y, h, k, len, start), and rq, a row for each route."""
    legs, corners = range(5), range(1, 5)
    want = ", ".join(f"radius * tan(abs(t{i}) / 2) AS w{i}" for i in corners)
    head = ", ".join(f"h0{''.join(f' + t{j}' for j in range(1, k + 1))} AS g{k}" for k in legs)
    fit = ", ".join(f"CASE WHEN w{k} + w{k + 1} > l{k} THEN l{k} / (w{k} + w{k + 1}) ELSE 1.0 END AS f{k}" for k in legs)
    keep = ", ".join(f"least(f{i - 1}, f{i}) AS q{i}" for i in corners)
    corner = ", ".join(f"x0{''.join(f' + l{j} * cos(g{j})' for j in range(k))} AS X{k}, y0{''.join(f' + l{j} * sin(g{j})' for j in range(k))} AS Y{k}" for k in range(1, 6))
    parts = []
    for k in legs:
        at = ("x0", "y0") if k == 0 else (f"X{k} + w{k} * q{k} * cos(g{k})", f"Y{k} + w{k} * q{k} * sin(g{k})")
        parts.append(f"SELECT rid, {2 * k} AS slot, {at[0]} AS x, {at[1]} AS y, g{k} AS h, 0.0::DOUBLE AS k, greatest(l{k} - w{k} * q{k} - w{k + 1} * q{k + 1}, 0) AS len FROM rq")
        if k < 4:
            n = k + 1
            parts.append(f"SELECT rid, {2 * k + 1}, X{n} - w{n} * q{n} * cos(g{k}), Y{n} - w{n} * q{n} * sin(g{k}), g{k}, CASE WHEN t{n} <> 0 THEN sign(t{n}) / (radius * q{n}) ELSE 0 END, CASE WHEN t{n} <> 0 THEN radius * q{n} * abs(t{n}) ELSE 0 END FROM rq")
    steps = f"wq AS (SELECT *, {want}, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w5, 1.0::DOUBLE AS q0, 1.0::DOUBLE AS q5, {head} FROM rt), fq AS (SELECT *, {fit} FROM wq), kq AS (SELECT *, {keep} FROM fq), rq AS (SELECT *, {corner} FROM kq)"
    return f"{BENT_SQL}, {steps}, p0 AS ({' UNION ALL '.join(parts)}), pc AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY rid ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM p0), pt AS (SELECT rid, sum(len) AS plan_m FROM pc GROUP BY rid)"


PLAN_SQL = _plan_sql()
#: Where the pieces meet grid lines (xs: rid, slot, s), and the stretches between (iv: rid, slot, a, b).
_STRAIGHT = "SELECT rid, slot, (n - {a}) / {c} AS s, len FROM (SELECT *, unnest(range(floor(least({a}, {a} + len * {c}))::BIGINT + 1, floor(greatest({a}, {a} + len * {c}))::BIGINT + 1)) AS n FROM pc WHERE k = 0 AND len > 0)"
_BEND = "SELECT rid, slot, (m * pi() + CASE WHEN m % 2 = 0 THEN 1 ELSE -1 END * asin(least(greatest((n - mid) * k, -1), 1)) - p) / k AS s, len FROM (SELECT *, unnest(range(floor(least(p, p + k * len) / pi() + 0.5)::BIGINT, floor(greatest(p, p + k * len) / pi() + 0.5)::BIGINT + 1)) AS m FROM (SELECT *, unnest(range(ceil(mid - 1 / abs(k))::BIGINT, floor(mid + 1 / abs(k))::BIGINT + 1)) AS n FROM (SELECT *, {a} - sin(p) / k AS mid FROM (SELECT *, {p} AS p FROM pc WHERE k <> 0 AND len > 0))))"
CROSS_SQL = f"{PLAN_SQL}, x0_ AS ({_STRAIGHT.format(a='x', c='cos(h)')} UNION ALL {_STRAIGHT.format(a='y', c='sin(h)')} UNION ALL {_BEND.format(a='x', p='h')} UNION ALL {_BEND.format(a='y', p='h - pi() / 2')}), xs AS (SELECT rid, slot, s FROM x0_ WHERE s BETWEEN 0 AND len UNION ALL SELECT rid, slot, 0 FROM pc WHERE len > 0 UNION ALL SELECT rid, slot, len FROM pc WHERE len > 0), iv AS (SELECT * FROM (SELECT rid, slot, s AS a, lead(s) OVER (PARTITION BY rid, slot ORDER BY s) AS b FROM xs) WHERE b IS NOT NULL)"


@query("j15_line_crossings", f"WITH {CROSS_SQL} SELECT rid, slot::INTEGER AS slot, count(*) FILTER (WHERE b - a > 1e-9) AS n, round(sum(b - a), 6) AS total, round(max(b - a), 6) AS longest FROM iv GROUP BY rid, slot")
def j15(spark, d):
    p = cable.plan(bent(spark, d)).select("rid", F.posexplode("pieces").alias("slot", "p")).select("rid", "slot", "p.x", "p.y", "p.h", "p.curvature", "p.length")
    i = cable.intervals(cable.line_crossings(p)).withColumn("step", F.col("b") - F.col("a"))
    return i.groupBy("rid", "slot").agg(F.count_if(F.col("step") > 1e-9).alias("n"), F.round(F.sum("step"), 6).alias("total"), F.round(F.max("step"), 6).alias("longest"))


CATALOGUE = [("a-33-spec", 33, 1000, 80.0, "spec"), ("b-33", 33, 1000, 70.0, "verified"), ("c-33", 33, 630, 60.0, "verified"), ("d-132", 132, 1000, 91.0, "verified"), ("e-132-spec", 132, 1000, 95.0, "verified")]
RULES = [(33, "single", "installation", 20.0, "x"), (33, "single", "installation", 15.0, "y"), (33, "single", "installed", 12.0, "z"), (132, "single", "installation", 35.0, "x"), (132, "single", "installation", None, "y")]


def _catalogue(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame(CATALOGUE, "id string, voltage_kv int, csa_mm2 int, od_mm double, od_status string"), spark.createDataFrame(RULES, "voltage_kv int, construction string, when string, multiple_of_od double, source string")


_VALUES = lambda rows: ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


@query("j16_bend_rule", f"WITH c(id, kv, csa, od, st) AS (VALUES {_VALUES(CATALOGUE)}), r(kv, con, w, m, src) AS (VALUES {_VALUES(RULES)}), f AS (SELECT *, row_number() OVER (PARTITION BY kv ORDER BY st <> 'verified', contains(id, 'spec'), id) AS n FROM c WHERE csa = 1000), g AS (SELECT kv, max(m) AS m FROM r WHERE w = 'installation' AND m <> 0 GROUP BY kv) SELECT f.kv::INTEGER AS voltage_kv, id AS cable_id, round(m::DOUBLE * od::DOUBLE / 1000, 9) AS radius_m, CASE f.kv WHEN 33 THEN 0.9 WHEN 132 THEN 1.05 END::DOUBLE AS depth_m FROM f JOIN g ON g.kv = f.kv WHERE n = 1")
def j16(spark, d):
    return cable.bend_rule(*_catalogue(spark)).select("voltage_kv", "cable_id", F.round("radius_m", 9).alias("radius_m"), "depth_m")


@query("j17_same_mask", f"WITH {surface_sql()} SELECT count(*) FILTER (WHERE (z IS NULL) <> (r % 50 = 7 OR z IS NULL)) = 0 AS mask_equal, count(*) FILTER (WHERE (z IS NULL) <> (r % 50 = 7 OR z IS NULL)) AS mismatches, round(max(abs(z - (z + 0.004))) FILTER (WHERE r % 50 <> 7), 6) AS max_err_m FROM s")
def j17(spark, d):
    s = surface(spark, d)
    return grid.same_mask(s, s.withColumn("z", F.when(F.col("r") % 50 != 7, F.col("z") + 0.004))).withColumn("max_err_m", F.round("max_err_m", 6))


@query("j10_piece_by_chainage", "WITH e AS (SELECT event_id AS k, (event_id * 7919 % 20000) / 1e3 AS s, 3 + event_id % 5 AS a, 10 + event_id % 7 AS b FROM events) SELECT k, ((s >= a)::INTEGER + (s >= a)::INTEGER + (s >= b)::INTEGER) AS slot FROM e")
def j10(spark, d):
    k = F.col("event_id")
    starts = [F.lit(0.0), (3 + k % 5).cast("double"), (3 + k % 5).cast("double"), (10 + k % 7).cast("double")]
    pieces = F.array(*[F.struct(F.lit(n).alias("slot"), x.alias("start")) for n, x in enumerate(starts)])
    return table(spark, d, "events").select(k.alias("k"), cable.piece_at((k * 7919 % 20000) / 1e3, pieces)["slot"].alias("slot"))


# ---------------------------------------------------------------- aggregates, windows, order
@query("p17_inside_site", f"WITH {TRENCH_SQL}, w AS (SELECT g.*, length * n / 63e0 AS s FROM g, range(64) AS t(n)), v AS (SELECT *, CASE WHEN s <= l1 THEN 0 WHEN s <= l1 + la THEN 1 ELSE 2 END AS piece FROM w), u AS (SELECT *, s - CASE WHEN piece >= 1 THEN l1 ELSE 0 END - CASE WHEN piece = 2 THEN la ELSE 0 END AS uu FROM v), hh AS (SELECT *, CASE piece WHEN 0 THEN h WHEN 1 THEN h + sg * uu / radius ELSE h2 END AS b FROM u), xy AS (SELECT tid, CASE piece WHEN 0 THEN ax + uu * cos(b) WHEN 1 THEN cx + sin(b) * sg * radius ELSE dx + uu * cos(b) END AS x, CASE piece WHEN 0 THEN ay + uu * sin(b) WHEN 1 THEN cy - cos(b) * sg * radius ELSE dy + uu * sin(b) END AS y FROM hh) SELECT tid, min(x) > 15 AND min(y) > 15 AND max(x) < 60 AND max(y) < 75 AS inside FROM xy GROUP BY tid")
def p17(spark, d):
    return works.inside_site(works.trench_geometry(trenches(spark, d)), 75.0, 90.0, 15.0)


_BENDS = " + ".join(f"(t{i} <> 0)::INTEGER" for i in range(1, 5))


def _listed(values: list[str], n: str, digits: int) -> str:
    return f"list_transform(list_slice([{', '.join(values)}], 1, {n}), lambda v: round_even(v, {digits}))"


@query("p21_route_rows", f"WITH {PLAN_SQL} SELECT rid, round_even(x0 + 400000.0::DOUBLE, 3) AS start_e, round_even(y0 + 300000.0::DOUBLE, 3) AS start_n, round_even(degrees(h0), 3) AS heading_deg, kv, {_listed([f'l{k}' for k in range(5)], f'{_BENDS} + 1', 3)} AS legs_m, {_listed([f'degrees(t{i})' for i in range(1, 5)], _BENDS, 3)} AS turns_deg, {_listed([f'CASE WHEN t{i} <> 0 THEN radius * q{i} ELSE 0 END' for i in range(1, 5)], _BENDS, 4)} AS fitted_radius_m, round_even(plan_m, 4) AS plan_m FROM rq JOIN pt USING (rid)")
def p21(spark, d):
    p = cable.plan(bent(spark, d)).withColumns({"sampled_m": F.col("plan_m"), "analytic_m": F.col("plan_m"), "disagreement": F.lit(0.0)})
    return cable.route_rows(p, (400000.0, 300000.0)).select("rid", "start_e", "start_n", "heading_deg", "kv", "legs_m", "turns_deg", "fitted_radius_m", "plan_m")


@query("t1_worst_samples", HEADED_SQL + ", x AS (SELECT tile, i, j, (base_cm + q) / 1e2 AS h_tile, abs((base_cm + q) / 1e2 - z) AS err FROM t JOIN (SELECT ix, iy, i, j, z FROM ct) USING (ix, iy, i, j) WHERE q <> 65535) SELECT tile, i, j, h_tile FROM x WHERE err IS NOT NULL ORDER BY err DESC, tile, i, j LIMIT 8")
def t1(spark, d):
    t, _ = _headed(spark, d)
    h = verify.sample_heights(t, grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS, (0.0, 0.0)).withColumn("err_m", F.abs(F.col("h_tile") - F.col("h_source")))
    return verify.worst(h, "err_m", "tile", "i", "j").select("tile", "i", "j", "h_tile")


@query("w4_neighbours", f"WITH {surface_sql()}, {STENCIL_SQL} SELECT r, c, z, a, b, c_, d, f, g, h, k FROM nb")
def w4(spark, d):
    return terrain.neighbours(surface(spark, d)).select("r", "c", "z", "a", "b", "c_", "d", "f", "g", "h", "k")


@query("w5_horn_class", f"WITH {surface_sql(200)}, {STENCIL_SQL} SELECT r, c, round(p, 9) + 0.0 AS p, round(q, 9) + 0.0 AS q, round(horn_pct, 6) AS horn_pct, {CLASS_SQL} AS cls, {ASPECT_SQL} AS asp FROM sl")
def w5(spark, d):
    s = terrain.slopes(surface(spark, d, 200))
    return s.select("r", "c", (F.round("p", 9) + 0.0).alias("p"), (F.round("q", 9) + 0.0).alias("q"), F.round("horn_pct", 6).alias("horn_pct"), S.slope_class(F.col("horn_pct")).alias("cls"), S.octant(F.col("p"), F.col("q"), F.col("horn_pct")).alias("asp"))


@query("w6_rook_slope", f"WITH {surface_sql()}, {STENCIL_SQL} SELECT r, c, round(rook_pct, 6) AS rook_pct, round(curvature, 6) AS curvature, valid, photon FROM sv")
def w6(spark, d):
    return terrain.slopes(surface(spark, d)).select("r", "c", F.round("rook_pct", 6).alias("rook_pct"), F.round("curvature", 6).alias("curvature"), "valid", "photon")


@query("w8_witness", f"WITH {surface_sql()}, {STENCIL_SQL} SELECT sl.r, sl.c, round(horn_pct, 6) AS horn_pct, round(rook_pct, 6) AS rook_pct FROM sl JOIN nb USING (r, c) WHERE z IS NOT NULL AND horn_pct IS NOT NULL")
def w8(spark, d):
    return terrain.witness(surface(spark, d)).select("r", "c", F.round("horn_pct", 6).alias("horn_pct"), F.round("rook_pct", 6).alias("rook_pct"))


BREAK_SQL = f"WITH {surface_sql()}, {STENCIL_SQL}, k AS (SELECT quantile_cont(curvature, 0.95) AS cut FROM sv WHERE valid), b AS (SELECT sv.*, cut, coalesce(curvature >= cut AND curvature > 1e-6, false) AS brk FROM sv, k), m AS (SELECT *, max(brk) OVER (PARTITION BY c ORDER BY r ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m1 FROM b), nr AS (SELECT *, max(m1) OVER (PARTITION BY r ORDER BY c ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AND valid AS near_brk FROM m)"


@query("w9_breaks", BREAK_SQL + " SELECT r, c, brk, near_brk FROM nr")
def w9(spark, d):
    return terrain.breaks(terrain.slopes(surface(spark, d))).select("r", "c", "brk", "near_brk")


@query("j19_photons_near_breaks", BREAK_SQL + " SELECT count(*) FILTER (WHERE valid) AS valid, count(*) FILTER (WHERE photon) AS photons, count(*) FILTER (WHERE photon AND near_brk) AS on_breaks, count(*) FILTER (WHERE near_brk) AS near_breaks, round(max(cut), 6) AS curvature_p95, round(avg(horn_pct) FILTER (WHERE valid), 6) AS horn_mean, round(max(horn_pct) FILTER (WHERE valid), 6) AS horn_max, round(avg(rook_pct) FILTER (WHERE valid), 6) AS rook_mean, round(max(rook_pct) FILTER (WHERE valid), 6) AS rook_max, round(max(abs(horn_pct - rook_pct)) FILTER (WHERE valid), 6) AS max_diff_pp FROM nr")
def j19(spark, d):
    s = terrain.slope_statistics(terrain.breaks(terrain.slopes(surface(spark, d))))
    return s.withColumns({x: F.round(x, 6) for x in ("curvature_p95", "horn_mean", "horn_max", "rook_mean", "rook_max", "max_diff_pp")})


#: A site of the default size, 2,049 nodes a side.
SITE = 2049
SITE_SQL = f"s AS (SELECT r::INTEGER AS r, c::INTEGER AS c, (8000 + 2 * c + r + (r * 37 + c * 91) % 40 + (r * c) % 23)::DOUBLE / 1e2 AS z FROM range({SITE}) AS t(r), range({SITE}) AS u(c))"


@query("c3_default_site", f"WITH {SITE_SQL}, {STENCIL_SQL} SELECT count(*) FILTER (WHERE valid) AS valid, count(*) FILTER (WHERE photon) AS photons, round(avg(horn_pct), 6) AS horn_mean, round(max(horn_pct), 6) AS horn_max, round(avg(rook_pct), 6) AS rook_mean, round(max(rook_pct), 6) AS rook_max FROM sv")
def c3_site(spark, d):
    r, c = F.col("r").cast("long"), F.col("c").cast("long")
    z = (8000 + 2 * c + r + (r * 37 + c * 91) % 40 + (r * c) % 23) / 100.0
    s = terrain.slopes(grid.lattice(spark, SITE, SITE).withColumn("z", z))
    ok = lambda x: F.when(F.col("valid"), F.col(x))
    return s.agg(F.count_if("valid").alias("valid"), F.count_if("photon").alias("photons"), *[F.round(f(ok(f"{k}_pct")), 6).alias(f"{k}_{n}") for k in ("horn", "rook") for n, f in (("mean", F.avg), ("max", F.max))])


@query("a9_class_shares", f"WITH {surface_sql(200)}, {STENCIL_SQL}, t AS (SELECT {CLASS_SQL} AS cls FROM sv) SELECT k::INTEGER AS cls, count(*) FILTER (WHERE cls = k) AS n, round_even(count(*) FILTER (WHERE cls = k)::DOUBLE / count(*) FILTER (WHERE cls <> 255), 6) AS share FROM t, (VALUES (0), (1), (2), (3), (4), (5)) AS x(k) GROUP BY k")
def a9(spark, d):
    return terrain.shares(terrain.classes(surface(spark, d, 200))).select("cls", "n", "share")


@query("a10_hot_cells", f"WITH {surface_sql()}, {STENCIL_SQL} SELECT (r // 16)::BIGINT AS cell_r, (c // 16)::BIGINT AS cell_c, count(*) AS photons FROM sv WHERE photon GROUP BY 1, 2 ORDER BY photons DESC, cell_r, cell_c LIMIT 8")
def a10(spark, d):
    return terrain.hot_cells(terrain.slopes(surface(spark, d)).where("photon"))


@query("t3_worst_photons", f"WITH {surface_sql()}, {STENCIL_SQL} SELECT r, c, round(horn_pct, 6) AS horn_pct, round(rook_pct, 6) AS rook_pct FROM sv WHERE photon ORDER BY abs(horn_pct - rook_pct) DESC, r, c LIMIT 8")
def t3(spark, d):
    return terrain.worst(terrain.slopes(surface(spark, d)).where("photon")).select("r", "c", F.round("horn_pct", 6).alias("horn_pct"), F.round("rook_pct", 6).alias("rook_pct"))


@query("j21_slope_witness")
def j21s(spark, d):
    g = surface(spark, d)
    return terrain.witness_counts(terrain.slopes(g), terrain.witness(g)).withColumns({x: F.round(x, 6) for x in ("horn_max_diff", "rook_max_diff")})


@query("a6_percentiles", f"WITH {surface_sql()} SELECT c, round(min(z), 6) AS p0, round(quantile_cont(z, 0.05), 6) AS p5, round(quantile_cont(z, 0.5), 6) AS p50, round(quantile_cont(z, 0.95), 6) AS p95, round(max(z), 6) AS p100, round(median(z), 6) AS m FROM s GROUP BY c")
def a6(spark, d):
    p = surface(spark, d).groupBy("c").agg(F.expr("percentile(z, array(0, .05, .5, .95, 1))").alias("p"), F.round(F.median("z"), 6).alias("m"))
    return p.select("c", *[F.round(F.col("p")[k], 6).alias(f"p{n}") for k, n in enumerate((0, 5, 50, 95, 100))], "m")


@query("a8_routes_by_bends", "SELECT b::BIGINT AS bends, count(s_suppkey) AS routes FROM (VALUES (0), (1), (2), (3), (4)) AS t(b) LEFT JOIN supplier ON s_suppkey % 3 = b GROUP BY b")
def a8(spark, d):
    k = F.col("s_suppkey")
    t = table(spark, d, "supplier").select(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i < k % 3, 0.5).otherwise(0.0)).alias("turns"))
    return cable.by_bends(t)


CHORD_SQL = f"WITH {surface_sql()}, {CELLS_SQL}, {STRAIGHT_SQL}, m AS (SELECT *, ceil(len / 0.05)::BIGINT + 1 AS n FROM st), q AS (SELECT rid, k, k * (len / (n - 1)) AS sx, x0, y0, h0 FROM (SELECT *, unnest(range(0, n)) AS k FROM m)), xy AS (SELECT rid, k, x0 + sx * cos(h0) AS x, y0 + sx * sin(h0) AS y FROM q), a AS (SELECT *, {GROUND_SQL.format(x='x', y='y')} FROM xy), z AS (SELECT rid, k, x, y, {LERP_SQL.format(x='x', y='y')} AS z FROM a LEFT JOIN cells USING (i, j)), dd AS (SELECT rid, k, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, z - lag(z) OVER w AS dz FROM z WINDOW w AS (PARTITION BY rid ORDER BY k))"


@query("a16_chord_lengths", CHORD_SQL + " SELECT rid, round(CASE WHEN count(*) FILTER (WHERE k > 0 AND dz IS NULL) = 0 THEN sum(sqrt(dx * dx + dy * dy + dz * dz)) END, 5) AS sampled_m, round(sum(sqrt(dx * dx + dy * dy)), 5) AS chords_m FROM dd GROUP BY rid")
def a16(spark, d):
    p = cable.samples(cable.plan(straights(spark, d)))
    h = grid.ground_height(p, grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS)
    return cable.chord_lengths(h).select("rid", F.round("sampled_m", 5).alias("sampled_m"), F.round("chords_m", 5).alias("chords_m"))


@query("w13_cable_plan", f"WITH {PLAN_SQL}, lq AS (SELECT rid, list(round(len, 6) ORDER BY slot) AS lengths FROM pc GROUP BY rid) SELECT rid, [{', '.join(f'round(CASE WHEN t{i} <> 0 THEN radius * q{i} ELSE 0 END, 6)' for i in range(1, 5))}] AS fitted, [{', '.join(f't{i} <> 0 AND q{i} < 1 - 1e-9' for i in range(1, 5))}] AS tight, round(plan_m, 6) AS plan_m, lengths FROM rq JOIN pt USING (rid) JOIN lq USING (rid)")
def w13(spark, d):
    return cable.plan(bent(spark, d)).select("rid", F.transform("fitted", lambda x: F.round(x, 6)).alias("fitted"), "tight", F.round("plan_m", 6).alias("plan_m"), F.transform("pieces", lambda p: F.round(p["length"], 6)).alias("lengths"))


_SINC = "CASE WHEN k * u = 0 THEN u ELSE u * sin(k * u / 2) / (k * u / 2) END"
_AT_U = f"x + {_SINC} * cos(h + k * u / 2) AS gx, y + {_SINC} * sin(h + k * u / 2) AS gy"
_GAUSS = ", ".join(f"({(x + 1) / 2!r}::DOUBLE, {w / 2!r}::DOUBLE)" for x, w in zip(cable.GAUSS_X.tolist(), cable.GAUSS_W.tolist(), strict=True))
#: The lengths of routes by both methods (both: rid, sampled_m, chords_m, analytic_m, n_samples).
LENGTH_SQL = f"""WITH {surface_sql()}, {CELLS_SQL}, {CROSS_SQL},
ns AS (SELECT rid, plan_m, ceil(plan_m / 0.05)::BIGINT + 1 AS n FROM pt),
sm AS (SELECT rid, n, i, i * (plan_m / (n - 1)) AS ch FROM (SELECT *, unnest(range(0, n)) AS i FROM ns)),
lv AS (SELECT *, lead(start) OVER (PARTITION BY rid ORDER BY slot) AS until FROM pc WHERE len > 0),
su AS (SELECT sm.rid, n, i, x, y, h, k, ch - start AS u FROM sm JOIN lv ON sm.rid = lv.rid AND ch >= start AND (until IS NULL OR ch < until)),
sp AS (SELECT rid, n, i, {_AT_U} FROM su),
sc AS (SELECT *, {GROUND_SQL.format(x='gx', y='gy').replace(' AS j', ' AS j_').replace(' AS i', ' AS i_')} FROM sp),
sz AS (SELECT rid, n, sc.i, gx, gy, {LERP_SQL.format(x='gx', y='gy').replace('- j', '- j_').replace('- i', '- i_')} AS z FROM sc LEFT JOIN cells ON cells.i = i_ AND cells.j = j_),
sd AS (SELECT rid, n, i, gx - lag(gx) OVER w AS dx, gy - lag(gy) OVER w AS dy, z - lag(z) OVER w AS dz FROM sz WINDOW w AS (PARTITION BY rid ORDER BY i)),
sampled AS (SELECT rid, any_value(n) AS n_samples, CASE WHEN count(*) FILTER (WHERE i > 0 AND dz IS NULL) = 0 THEN sum(sqrt(dx * dx + dy * dy + dz * dz)) END AS sampled_m, sum(sqrt(dx * dx + dy * dy)) AS chords_m FROM sd GROUP BY rid),
im AS (SELECT iv.rid, iv.slot, a, b, x, y, h, k, (a + b) / 2 AS u FROM iv JOIN pc USING (rid, slot)),
ic AS (SELECT rid, slot, a, b, x, y, h, k, {GROUND_SQL.format(x='gx', y='gy')} FROM (SELECT *, {_AT_U} FROM im)),
ig AS (SELECT ic.*, h10 - h00 AS e, h01 - h00 AS o, h11 - h10 - h01 + h00 AS tw FROM ic LEFT JOIN cells USING (i, j)),
sl2 AS (SELECT *, (e + tw * (y + a * sin(h) - i)) * cos(h) + (o + tw * (x + a * cos(h) - j)) * sin(h) AS g0, (e + tw * (y + b * sin(h) - i)) * cos(h) + (o + tw * (x + b * cos(h) - j)) * sin(h) AS g1 FROM ig WHERE k = 0),
c1_ AS (SELECT rid, CASE WHEN abs(g1 - g0) <= 1e-7 THEN (g0 + g1) / 2 * ((g0 + g1) / 2) / (1 + sqrt(1 + (g0 + g1) / 2 * ((g0 + g1) / 2))) ELSE ((g1 * sqrt(1 + g1 * g1) + asinh(g1)) / 2 - (g0 * sqrt(1 + g0 * g0) + asinh(g0)) / 2) / nullif(g1 - g0, 0) - 1 END * (b - a) AS extra FROM sl2),
gu AS (SELECT ig.*, a + (b - a) * gx AS u, gw FROM ig, (VALUES {_GAUSS}) AS q(gx, gw) WHERE k <> 0),
gs AS (SELECT *, (e + tw * (gy - i)) * cos(h + k * u) + (o + tw * (gx - j)) * sin(h + k * u) AS g FROM (SELECT *, {_AT_U} FROM gu)),
ex AS (SELECT * FROM c1_ UNION ALL SELECT rid, g * g / (1 + sqrt(1 + g * g)) * gw * (b - a) FROM gs),
analytic AS (SELECT rid, CASE WHEN count(*) FILTER (WHERE extra IS NULL) = 0 THEN sum(extra) END AS extra FROM ex GROUP BY rid),
both_ AS (SELECT rid, sampled_m, chords_m, plan_m + extra AS analytic_m, n_samples FROM sampled JOIN analytic USING (rid) JOIN pt USING (rid))"""


def _length_pairs(spark: SparkSession, d: str) -> DataFrame:
    planned = cable.plan(bent(spark, d))
    return cable.length_pair(planned, grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS).join(planned.withColumnRenamed("rid", "route").hint("merge"), F.col("rid") == F.col("route")).drop("route")


@query("c5_cable_pair", LENGTH_SQL + " SELECT rid, round(sampled_m, 5) AS sampled_m, round(chords_m, 5) AS chords_m, round(analytic_m, 5) AS analytic_m, n_samples FROM both_")
def c5(spark, d):
    return _length_pairs(spark, d).select("rid", *[F.round(x, 5).alias(x) for x in ("sampled_m", "chords_m", "analytic_m")], "n_samples")


@query("a15_arc_corrections", LENGTH_SQL + " SELECT rid, count(*) FILTER (WHERE b - a > 1e-9) AS n, round(CASE WHEN count(*) FILTER (WHERE g IS NULL) = 0 THEN sum(g * g / (1 + sqrt(1 + g * g)) * gw * (b - a)) END, 6) AS arcs_m FROM gs GROUP BY rid")
def a15(spark, d):
    """What the ground's slope adds on bends only."""
    p = cable.plan(bent(spark, d))
    pieces = F.filter("pieces", lambda q: q["curvature"] != 0)
    arcs = p.withColumn("pieces", pieces).where(F.size("pieces") > 0)
    got = cable.length_pair(arcs, grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS).select("rid", F.round("correction_m", 6).alias("arcs_m"))
    live = arcs.select("rid", F.posexplode("pieces").alias("slot", "p")).select("rid", "slot", "p.x", "p.y", "p.h", "p.curvature", "p.length")
    n = cable.intervals(cable.line_crossings(live)).where("b - a > 1e-9").groupBy("rid").agg((6 * F.count("*")).alias("n"))
    return got.join(n.hint("merge"), "rid").select("rid", "n", "arcs_m")


_REL = "abs(sampled_m - analytic_m) / greatest(sampled_m, analytic_m, 1e-12)"


@query("t2_worst_routes", LENGTH_SQL + f" SELECT rid, round(analytic_m, 5) AS analytic_m FROM both_ ORDER BY {_REL} DESC NULLS LAST, rid LIMIT 8")
def t2(spark, d):
    return _length_pairs(spark, d).orderBy(F.desc_nulls_last("disagreement"), "rid").limit(8).select("rid", F.round("analytic_m", 5).alias("analytic_m"))


@query("a11_extra_by_voltage", LENGTH_SQL + f", e AS (SELECT kv, plan_m, analytic_m, {' OR '.join(f'(t{i} <> 0 AND q{i} < 1 - 1e-9)' for i in range(1, 5))} AS tight, {' OR '.join(f't{i} <> 0' for i in range(1, 5))} AS bent FROM both_ JOIN pt USING (rid) JOIN rq USING (rid)) SELECT kv, count(*) AS routes, round(sum(plan_m) / 1000, 6) AS plan_km, round(sum(analytic_m) / 1000, 6) AS cable_km, round(quantile_cont(100 * (analytic_m - plan_m) / plan_m, 0.5), 5) AS extra_percent_median, count(*) FILTER (WHERE tight) AS tight_routes, count(*) FILTER (WHERE bent) AS bent_routes FROM e GROUP BY kv")
def a11(spark, d):
    got = cable.extra_by_voltage(_length_pairs(spark, d))
    return got.select("kv", "routes", *[F.round(x, 6).alias(x) for x in ("plan_km", "cable_km")], F.round(F.col("extra_percent")[3], 5).alias("extra_percent_median"), "tight_routes", "bent_routes")


@query("a17_fitted_radii", f"WITH {PLAN_SQL}, f AS ({' UNION ALL '.join(f'SELECT rid, t{i} AS t, q{i} AS q, radius * q{i} AS r FROM rq' for i in range(1, 5))}) SELECT round(min(r) FILTER (WHERE t <> 0), 6) AS smallest_fitted_radius_m, count(*) FILTER (WHERE t <> 0 AND q < 1 - 1e-9) AS bends_below_min, count(*) FILTER (WHERE t <> 0) AS bends_total, count(DISTINCT rid) FILTER (WHERE t <> 0 AND q < 1 - 1e-9) AS routes_with_violation FROM f")
def a17(spark, d):
    return cable.bend_radii(cable.plan(bent(spark, d))).withColumn("smallest_fitted_radius_m", F.round("smallest_fitted_radius_m", 6))


@query("a19_length_counts", LENGTH_SQL + f" SELECT count(*) AS routes, count(*) FILTER (WHERE {_REL} > 1e-3) AS photons, count(*) FILTER (WHERE sampled_m IS NULL OR analytic_m IS NULL) AS undefined, sum(n_samples)::BIGINT AS samples, round(max(abs(chords_m - plan_m) / plan_m), 6) AS max_plan_error FROM both_ JOIN pt USING (rid)")
def a19(spark, d):
    got = cable.length_counts(_length_pairs(spark, d), S.TOL_LENGTH)
    return got.select("routes", "photons", "undefined", "samples", F.round("max_plan_error", 6).alias("max_plan_error"))


#: The volumes of trenches by points of the cells near them (vp) and by cross-sections (vs).
_HEIGHT = "(({p}h00 + ({p}h10 - {p}h00) * ({x} - {p}j)) + (({p}h01 + ({p}h11 - {p}h01) * ({x} - {p}j)) - ({p}h00 + ({p}h10 - {p}h00) * ({x} - {p}j))) * ({y} - {p}i))"
_CELL = "least(greatest(floor({x}), 0), 98)::INTEGER = {p}j AND least(greatest(floor({y}), 0), (SELECT max(r) FROM s) - 1)::INTEGER = {p}i"
VOLUME_SQL = f"""WITH {surface_sql()}, {CELLS_SQL}, {TRENCH_SQL}, {NEAR_SQL},
dots AS (SELECT n.tid, ix + (a + 0.5) / 40 AS x, iy + (b + 0.5) / 40 AS y FROM near n, range(40) AS t(a), range(40) AS u(b)),
q1 AS (SELECT d.x, d.y, g.*, (d.x - ax) * cos(h) + (d.y - ay) * sin(h) AS s1, cos(h) * (d.y - ay) - sin(h) * (d.x - ax) AS t1, (d.x - dx) * cos(h2) + (d.y - dy) * sin(h2) AS s2, cos(h2) * (d.y - dy) - sin(h2) * (d.x - dx) AS t2, d.x - cx AS vx, d.y - cy AS vy, bx - cx AS wx, by_ - cy AS wy FROM dots d JOIN g USING (tid)),
q2 AS (SELECT *, s1 BETWEEN 0 AND l1 AND abs(t1) <= width / 2 AS in1, sg <> 0 AND s2 BETWEEN 0 AND l2 AND abs(t2) <= width / 2 AS in2, sqrt(vx * vx + vy * vy) AS rr, atan2(wx * vy - wy * vx, wx * vx + wy * vy) * sg AS turn FROM q1),
q3 AS (SELECT tid, x, y, depth, CASE WHEN in1 THEN ax + s1 * cos(h) WHEN in2 THEN dx + s2 * cos(h2) ELSE cx + vx * radius / rr END AS fx, CASE WHEN in1 THEN ay + s1 * sin(h) WHEN in2 THEN dy + s2 * sin(h2) ELSE cy + vy * radius / rr END AS fy FROM q2 WHERE in1 OR in2 OR (sg <> 0 AND turn BETWEEN 0 AND th AND abs(radius - rr) <= width / 2)),
q4 AS (SELECT tid, {_HEIGHT.format(p='p.', x='q.x', y='q.y')} - {_HEIGHT.format(p='f.', x='q.fx', y='q.fy')} + depth AS dug FROM q3 q LEFT JOIN cells p ON {_CELL.format(p='p.', x='q.x', y='q.y')} LEFT JOIN cells f ON {_CELL.format(p='f.', x='q.fx', y='q.fy')}),
vp AS (SELECT tid, CASE WHEN count(*) FILTER (WHERE dug IS NULL) = 0 THEN sum(greatest(dug, 0)) / 1600 END AS prism_m3 FROM q4 GROUP BY tid),
r1 AS (SELECT *, unnest(range(0, ceil(len / 0.1)::BIGINT)) AS m, ceil(len / 0.1) AS n FROM pcs WHERE len > 0),
r2 AS (SELECT *, (m + 0.5) * (len / n) AS u FROM r1),
r3 AS (SELECT *, {_AT_U}, h + k * u AS hh, ((o + 0.5) / 33 - 0.5) * width AS across FROM r2, range(33) AS t(o)),
r4 AS (SELECT *, gx - across * sin(hh) AS px, gy + across * cos(hh) AS py FROM r3),
r5 AS (SELECT tid, {_HEIGHT.format(p='p.', x='px', y='py')} - {_HEIGHT.format(p='f.', x='gx', y='gy')} + depth AS dug, (1 - k * across) * (len / n) * (width / 33) AS part FROM r4 LEFT JOIN cells p ON {_CELL.format(p='p.', x='px', y='py')} LEFT JOIN cells f ON {_CELL.format(p='f.', x='gx', y='gy')}),
vs AS (SELECT tid, CASE WHEN count(*) FILTER (WHERE dug IS NULL) = 0 THEN sum(greatest(dug, 0) * part) END AS section_m3 FROM r5 GROUP BY tid),
vn AS (SELECT tid, count(*) * 1600 AS n_points FROM near GROUP BY tid)"""


def _volume_pairs(spark: SparkSession, d: str) -> DataFrame:
    return works.trench_pair(works.trench_geometry(trenches(spark, d)), grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS)


@query("c4_trench_pair", VOLUME_SQL + " SELECT tid, round(prism_m3, 4) AS prism_m3, round(section_m3, 4) AS section_m3, n_points FROM vn JOIN vp USING (tid) JOIN vs USING (tid)")
def c4(spark, d):
    return _volume_pairs(spark, d).select("tid", F.round("prism_m3", 4).alias("prism_m3"), F.round("section_m3", 4).alias("section_m3"), "n_points")


@query("a13_volume_counts", VOLUME_SQL + " SELECT count(*) AS trenches, count(*) FILTER (WHERE abs(prism_m3 - section_m3) / greatest(prism_m3, section_m3, 1e-12) > 0.005) AS photons, count(*) FILTER (WHERE prism_m3 IS NULL OR section_m3 IS NULL) AS undefined, round(sum(prism_m3), 3) AS total_prism_m3, round(sum(section_m3), 3) AS total_section_m3, sum(n_points)::BIGINT AS points FROM vn JOIN vp USING (tid) JOIN vs USING (tid)")
def a13(spark, d):
    got = works.volume_counts(_volume_pairs(spark, d), S.TOL_VOLUME)
    return got.select("trenches", "photons", "undefined", F.round("total_prism_m3", 3).alias("total_prism_m3"), F.round("total_section_m3", 3).alias("total_section_m3"), "points")


PAD = [(40.0, 30.0), (44.0, 30.0), (44.0, 33.0), (40.0, 33.0)]


@query("c4_platform_pair", f"WITH {surface_sql()}, {CELLS_SQL}, p AS (SELECT 40 + (a + 0.5::DOUBLE) * 0.025::DOUBLE AS x, 30 + (b + 0.5::DOUBLE) * 0.025::DOUBLE AS y FROM range(160) AS t(a), range(120) AS u(b)), q AS (SELECT *, {GROUND_SQL.format(x='x', y='y')} FROM p), h AS (SELECT {LERP_SQL.format(x='x', y='y')} - 81.0::DOUBLE AS dz FROM q JOIN cells USING (i, j)), sx AS (SELECT k, 40 + k * 0.1::DOUBLE + CASE k WHEN 0 THEN 1e-10 WHEN 40 THEN -1e-10 ELSE 0 END AS x, CASE WHEN k IN (0, 40) THEN 0.05::DOUBLE ELSE 0.1 END AS ds FROM range(41) AS t(k)), sy AS (SELECT x, ds, 30 + 3 * m / 132::DOUBLE AS y, 3 * CASE WHEN m IN (0, 132) THEN 0.5::DOUBLE ELSE 1 END / 132 AS dt FROM sx, range(133) AS t(m)), sq AS (SELECT *, {GROUND_SQL.format(x='x', y='y')} FROM sy), sh AS (SELECT {LERP_SQL.format(x='x', y='y')} - 81.0::DOUBLE AS dz, ds * dt AS part FROM sq JOIN cells USING (i, j)) SELECT 0::BIGINT AS pid, (SELECT round(sum(greatest(dz, 0)) * 0.025 * 0.025, 6) FROM h) AS prism_cut, (SELECT round(sum(greatest(-dz, 0)) * 0.025 * 0.025, 6) FROM h) AS prism_fill, (SELECT round(sum(greatest(dz, 0) * part), 5) FROM sh) AS section_cut, (SELECT round(sum(greatest(-dz, 0) * part), 5) FROM sh) AS section_fill")
def c4p(spark, d):
    one = spark.range(1).select(F.col("id").alias("pid"), works.polygon_literal(PAD).alias("polygon"), F.lit(81.0).alias("level"))
    got = works.platform_pair(one, grid.cell_table(surface(spark, d)), n_rows(spark, d), COLS)
    return got.select("pid", *[F.round(x, n).alias(x) for x, n in (("prism_cut", 6), ("prism_fill", 6), ("section_cut", 5), ("section_fill", 5))])


@query("e1_exact_set_differences", "SELECT 'orders only' AS side, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT event_id FROM events) UNION ALL SELECT 'events only', count(*) FROM events WHERE event_id NOT IN (SELECT o_orderkey FROM orders)")
def e1(spark, d):
    a, b = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), table(spark, d, "events").select(F.col("event_id").alias("k"))
    n = lambda x, y, s: verify.only_in(x, y, "k").agg(F.count("*").alias("n")).select(F.lit(s).alias("side"), "n")
    return n(a, b, "orders only").unionByName(n(b, a, "events only"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Slope classes and aspects of the surface."""
    return p7(spark, d)

