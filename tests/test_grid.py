import hashlib
import json
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from upland.functions import scalars as S
from upland.operators import grid as G
from upland.plans import runs
from upland.sources import coverage, rasters, tiles


def array_grid(spark, z):
    rows = [(r, c, None if not np.isfinite(v) else float(v)) for (r, c), v in np.ndenumerate(z)]
    return spark.createDataFrame(rows, "r int, c int, z double")


def test_layout_of_a_height_tile():
    q = np.zeros((257, 257), np.uint16)
    q[3, 4] = tiles.NO_HEIGHT
    data = tiles.pack_heights(q, 4200, 400000, 300000)
    assert len(data) == 132130 and data[:4] == b"GGH1" and data[4:10] == bytes.fromhex("01000101e803")
    head, body = tiles.unpack_heights(data)
    assert (head["base_cm"], head["min_q"], head["max_q"], head["nodata_count"]) == (4200, 0, 0, 1) and (body == q).all()
    with pytest.raises(ValueError):
        tiles.unpack_heights(data + b"x")
    with pytest.raises(ValueError):
        tiles.unpack_heights(b"XXXX" + data[4:])
    longer = data[:32] + b"extra" + data[32:]
    head, body = tiles.unpack_heights(longer, strict=False)
    assert head["header_bytes"] == 37 and (body == q).all()


def test_rows_run_north(spark):
    z = np.full((257, 257), 50.0)
    z[0] += 1
    z[5, -1] += 2
    t = G.quantise(G.cut(array_grid(spark, z), 257, 257))
    q = {(r.i, r.j): r.q for r in t.where("(i = 0 AND j = 0) OR (i = 1 AND j = 0) OR (i = 5 AND j = 256)").collect()}
    assert q == {(0, 0): 100, (1, 0): 0, (5, 256): 200}


def test_relief_too_large(spark):
    with pytest.raises(Exception, match="relief"):
        G.quantise(spark.createDataFrame([(0, 0, 0, 0, 0.0), (0, 0, 0, 1, 655.35)], "ix int, iy int, i int, j int, z double")).collect()
    assert {r.q for r in G.quantise(spark.createDataFrame([(0, 0, 0, 0, 0.0), (0, 0, 0, 1, 655.34), (0, 0, 1, 1, 0.005), (0, 0, 1, 0, 0.015)], "ix int, iy int, i int, j int, z double")).collect()} == {0, 65534, 2}  # ties to even


def test_too_small_to_cut(spark):
    with pytest.raises(ValueError):
        G.cut(array_grid(spark, np.zeros((257, 1))), 257, 1)


def test_site_round_trip(spark, tmp_path):
    rng = np.random.default_rng(7)
    y, x = np.mgrid[0:513, 0:513].astype(float)
    z = 120 + 25 * np.sin(x / 90) * np.cos(y / 70) - 18 * np.exp(-((x - 256) ** 2) / 3200) + 0.004 * x + rng.normal(0, 0.03, x.shape)
    z[10:14, 300:305], z[400, :50], z[200, 200] = np.nan, np.nan, np.inf
    z[~np.isfinite(z)] = np.nan
    g = rasters_frame(spark, z).persist()
    manifest = runs.cut_site(g, 513, 513, (400000, 300000), str(tmp_path), "t", clock=lambda: "t")
    assert len(manifest["tiles"]) == 4 and sum(t["nodata"] for t in manifest["tiles"]) >= 71
    said = json.loads((tmp_path / "tiles.json").read_text(encoding="utf-8"))
    assert said == manifest and all(hashlib.sha256((tmp_path / t["file"]).read_bytes()).hexdigest() == t["sha256"] for t in said["tiles"])
    _, back = runs.load_site(spark, str(tmp_path))
    check = G.same_mask(g, back).first()
    assert check.mask_equal and check.max_err_m <= 0.005 + 1e-9
    path = tmp_path / said["tiles"][1]["file"]
    path.write_bytes(path.read_bytes()[:-2] + b"\x01\x00")
    with pytest.raises(ValueError, match="sha256"):
        runs.load_site(spark, str(tmp_path))
    g.unpersist()


def rasters_frame(spark, z):
    import pandas as pd

    r, c = np.indices(z.shape)
    frame = spark.createDataFrame(pd.DataFrame({"r": r.ravel().astype("int32"), "c": c.ravel().astype("int32"), "z": z.ravel()}))
    return frame.withColumn("z", S.nan_to_null(F.col("z")))


def test_mosaic_first_wins_and_geotiff(spark):
    for deflate in (True, False):
        a = np.array([[1.0, 2.0], [-9999.0, 4.0]])
        g = rasters.read_geotiff(rasters.write_geotiff(a, 400000.0, 300002.0, -9999.0, deflate=deflate))
        assert g["z"].tolist() == a.tolist() and (g["west_e"], g["north_n"], g["dx"], g["dy"], g["nodata"]) == (400000.0, 300002.0, 1.0, 1.0, -9999.0)
    with pytest.raises(ValueError, match="EPSG"):
        rasters.read_geotiff(rasters.write_geotiff(a, 0.0, 0.0, epsg=4326))
    with pytest.raises(ValueError, match="TIFF"):
        rasters.read_geotiff(b"nonsense")
    files = spark.createDataFrame([(0, bytearray(rasters.write_geotiff(a, 400000.0, 300002.0, -9999.0))), (1, bytearray(rasters.write_geotiff(a + 10, 400000.0, 300002.0)))], "chunk int, content binary")
    pieces = rasters.geotiff_pieces(files, 400000, 300000, 3, 3).withColumn("z", S.mask_nodata(F.col("z"), F.col("nodata")))
    got = {(r.r, r.c): r.z for r in G.mosaic(G.lattice(spark, 3, 3), pieces).collect()}
    assert got == {(0, 0): None, (0, 1): 4.0, (1, 0): 1.0, (1, 1): 2.0, (0, 2): None, (1, 2): None, (2, 0): None, (2, 1): None, (2, 2): None}


def test_three_bilinears(spark):
    z = np.array([[0.0, 1.0, 2.0], [3.0, 5.0, np.nan], [6.0, 7.0, 8.0]])
    cells = G.cell_table(array_grid(spark, z))
    assert cells.count() == 4
    pts = spark.createDataFrame([(0, 0.5, 0.5), (1, 2.0, 0.0), (2, 1.0, 1.0), (3, 1.5, 0.0), (4, -0.1, 0.0), (5, 1.5, 0.5), (6, 2.0, 2.0), (7, -1.0, 0.5)], "k int, gx double, gy double")
    inside = {r.k: r.h for r in G.height_inside(pts, cells, 3, 3).collect()}
    assert inside == {0: 2.25, 1: 2.0, 2: 5.0, 3: 1.5, 4: None, 5: None, 6: 8.0, 7: None}
    ground = {r.k: r.h for r in G.ground_height(pts.withColumnsRenamed({"gx": "x", "gy": "y"}), cells, 3, 3).collect()}
    assert ground[0] == 2.25 and ground[2] is None and ground[3] is None and ground[7] == pytest.approx(1.5 - (1 + 0.5 * 1) * 1 - 0.0, abs=0.3)


def test_fetch_is_polite_and_cached(tmp_path):
    calls, waits = [], []
    image = rasters.write_geotiff(np.zeros((2, 2)), 0.0, 2.0)

    def opener(url):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("down")
        return "image/tiff", image

    service = coverage.Coverage("http://x", "some", str(tmp_path), opener, waits.append)
    path, size, fresh = service.chunk((0, 10, 0, 10))
    assert fresh and size == len(image) and waits == [3.0, 6.0] and calls[0].endswith("CoverageId=some&format=image/tiff&subset=E(0,10)&subset=N(0,10)")
    assert service.chunk((0, 10, 0, 10)) == (path, size, False)
    for kind, body in (("text/xml", b"<x/>"), ("image/tiff", b"<ExceptionReport/>"), ("image/tiff", b"II")):
        with pytest.raises(RuntimeError):
            coverage.Coverage("http://x", "some", str(tmp_path), lambda u, a=(kind, body): a, waits.append).chunk((1, 10, 0, 10))
    assert [f for _, _, _, f in service.chunks([(0, 10, 0, 10), (0, 10, 10, 20)])] == [False, True] and waits[-1] == 1.0
    assert coverage.boxes(0, 2049, 0, 1000) == [(0, 1000, 0, 1000), (1000, 2000, 0, 1000), (2000, 2049, 0, 1000)]


def _lzw(data):
    """The packing that unpack_lzw undoes."""
    table, width, held, bits, out = {bytes([i]): i for i in range(256)}, 9, 0, 0, bytearray()

    def put(code, width):
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
        held &= (1 << bits) - 1

    put(256, 9)
    now, size = b"", 258
    for i in data:
        if now + bytes([i]) in table:
            now += bytes([i])
            continue
        put(table[now], width)
        table[now + bytes([i])] = size
        size, now = size + 1, bytes([i])
        if size in (512, 1024, 2048):
            width += 1
        if size == 4094:
            put(256, width)
            table, width, size = {bytes([i]): i for i in range(256)}, 9, 258
    put(table[now], width)
    put(257, width)
    put(0, 7)
    return bytes(out)


def test_geotiff_compressions(spark, tmp_path):
    y, x = np.mgrid[0:97, 0:83]
    z = (50 + 10 * np.sin(x / 9) * np.cos(y / 7)).astype("f4").astype(float)
    z[3, 4] = -9999.0
    packs = {5: _lzw, 8: zlib.compress, 32773: lambda d: b"".join(bytes([len(p) - 1]) + p for p in (d[i : i + 100] for i in range(0, len(d), 100))), 50000: lambda d: zstandard.ZstdCompressor().compress(d)}
    for number, pack in packs.items():
        for predictor in (1, 3):
            g = rasters.read_geotiff(rasters.write_geotiff(z, 400000.0, 300097.0, -9999.0, packed=(number, pack), predictor=predictor))
            assert (g["z"] == z).all() and g["nodata"] == -9999.0 and (g["west_e"], g["north_n"], g["dx"], g["dy"]) == (400000.0, 300097.0, 1.0, 1.0)
    assert rasters.unpack_bits(bytes([254, 7, 128, 1, 8, 9])) == bytes([7, 7, 7, 8, 9])
    with pytest.raises(ValueError, match="compression 7"):
        rasters.read_geotiff(rasters.write_geotiff(z, 0.0, 0.0, packed=(7, bytes)))
    (tmp_path / "a.tif").write_bytes(rasters.write_geotiff(z, 400000.0, 300097.0, -9999.0))
    spark.dataSource.register(rasters.GeoTiff)
    got = spark.read.format("geotiff").load(str(tmp_path))
    assert got.count() == z.size and got.where("e = 400004 AND n = 300093").first()["z"] == -9999.0 and got.agg(F.min("n"), F.max("e")).first()[0:2] == (300000.0, 400082.0)


def test_affine_forms():
    tie = {rasters.PIXEL_SCALE: (2.0, 3.0, 0.0), rasters.TIEPOINT: (1.0, 2.0, 0.0, 100.0, 200.0, 0.0)}
    whole = {rasters.TRANSFORM: (2.0, 0.0, 0.0, 98.0, 0.0, -3.0, 0.0, 206.0, *[0.0] * 8)}
    assert rasters.affine(tie, False).tolist() == rasters.affine(whole, False).tolist() == [[2.0, 0.0, 98.0], [0.0, -3.0, 206.0]]
    assert rasters.affine(tie, True)[:, 2].tolist() == [97.0, 207.5]
    for bad in ({}, {rasters.TRANSFORM: (2.0, 0.1, 0.0, 98.0, 0.1, -3.0, 0.0, 206.0, *[0.0] * 8)}):
        with pytest.raises(ValueError):
            rasters.affine(bad, False)


def test_build_site(spark, tmp_path):
    def opener(url):
        e = [int(v) for v in url.split("subset=E(")[1].split(")")[0].split(",")]
        n = [int(v) for v in url.split("subset=N(")[1].split(")")[0].split(",")]
        north, east = np.meshgrid(np.arange(n[1] - 1, n[0] - 1, -1), np.arange(e[0], e[1]), indexing="ij")
        return "image/tiff", rasters.write_geotiff((east % 97) * 0.5 + (north % 89) * 0.25, float(e[0]), float(n[1]))

    got = runs.build_site(spark, "site", 400100, 300100, 256, str(tmp_path / "out"), str(tmp_path / "cache"), "http://x", "some", opener, lambda s: None, lambda s: None)
    assert got["chunks"] == 1 and got["max_err_m"] <= 0.005 + 1e-9 and len(got["manifest"]["tiles"]) == 1 and got["nodata"] == 0
    assert (got["manifest"]["site"]["origin_e"] % 256, runs.snapped_box(400100, 300100, 256)) == (0, (got["manifest"]["site"]["origin_e"], got["manifest"]["site"]["origin_n"]))
    with pytest.raises(ValueError):
        runs.snapped_box(0, 0, 100)


def test_numpy_grid_source(spark, tmp_path):
    z = np.arange(12.0).reshape(3, 4)
    z[1, 2] = np.nan
    np.save(tmp_path / "source.npy", z)
    spark.dataSource.register(rasters.NumpyGrid)
    for rows, flip in (("south-to-north", False), ("south_to_north", False), ("north_to_south", True)):
        (tmp_path / "source.json").write_text(json.dumps({"sw_e": 1, "y0": 2, "spacing_mm": 500, "rows": rows}))
        want = z[::-1] if flip else z
        got = {(r.r, r.c): r.z for r in spark.read.format("npygrid").load(str(tmp_path / "source.npy")).collect()}
        assert got == {(r, c): None if np.isnan(v) else v for (r, c), v in np.ndenumerate(want)}
    assert rasters.settings({"x0": 1, "south": 2, "cell_m": 3}) == (1.0, 2.0, 3.0) and rasters.settings({"sw_e": 1, "y0": 2, "spacing_mm": 500})[2] == 0.5
    with pytest.raises(ValueError):
        rasters.settings({"x0": 1})


def test_synthetic_repeats_and_differs(spark):
    a, b, c = (rasters.synthetic(spark, 20, 20, seed=s).orderBy("r", "c").collect() for s in (1, 1, 2))
    assert a == b != c and all(abs(r.z - 80) < 40 for r in a)


def test_scalars(spark):
    row = spark.range(1).select(
        S.mask_nodata(F.lit(float("nan"))).alias("a"), S.mask_nodata(F.lit(-1000.0)).alias("b"), S.mask_nodata(F.lit(7.0), F.lit(7.0)).alias("c"), S.mask_nodata(F.lit(7.0), F.lit(None).cast("double")).alias("d"),
        S.raw_nodata(F.lit(" -3.4e38 ")).alias("e"), S.raw_nodata(F.lit("x")).alias("f"), S.floor0(F.lit(None).cast("double")).alias("g"), S.floor0(F.lit(-2.0)).alias("h"), S.disagreement(F.lit(None).cast("double"), F.lit(1.0)).alias("i"),
        S.snapped(F.lit(400100.0), F.lit(512)).alias("j"), S.photon(F.lit(1.0), F.lit(None).cast("double"), 0.1).alias("k"),
    ).first()
    assert tuple(row) == (None, -1000.0, None, 7.0, -3.4e38, None, None, 0.0, None, 399872, False)
