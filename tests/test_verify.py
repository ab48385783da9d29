import numpy as np
import pytest
from pyspark.sql import functions as F

from upland.operators.grid import lattice
from upland.plans import runs
from upland.sources import rasters
from upland.sources.tiles import HeightTiles, decode_heights, pack_heights, tile_files, unpack_heights

ORIGIN = (400000, 300000)


@pytest.fixture(scope="module")
def site(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("site")
    grid = rasters.synthetic(spark, 513, 513).persist()
    runs.cut_site(grid, 513, 513, ORIGIN, str(out), "synthetic")
    yield out, grid
    grid.unpersist()


def check(spark, site, **kw):
    out, grid = site
    files = tile_files(spark, str(out))
    tiles = decode_heights(files, strict=False).join(F.broadcast(files.select("path", "tile")), "path")
    return runs.verify_tiles(spark, tiles, grid, (513, 513), ORIGIN, **{"points": 4000, "seconds": 600.0, "batch": 2500} | kw)


def poke(site, change):
    path = sorted((site[0] / "tiles").glob("*.ght"))[0]
    data = path.read_bytes()
    head, q = unpack_heights(data)
    q = q.copy()
    path.write_bytes(change(head, q, data))
    return lambda: path.write_bytes(data)


def packed(head, q, **new):
    data = bytearray(pack_heights(q, head["base_cm"], head["origin_e_m"], head["origin_n_m"]))
    return bytes(data)


def test_clean(spark, site):
    r = check(spark, site)
    assert r["photons_total"] == 0 and r["tiles"] == 4 and r["electron"]["samples"] == 4 * 257**2 and r["edges"]["pairs"] == 4
    assert len(r["check_points"]) == 16 and r["positron"]["batches"] == 2 and r["positron"]["stopped_by"] == "points"
    again = check(spark, site)
    assert again["check_points"] == r["check_points"] and check(spark, site, seed=5)["check_points"] != r["check_points"]
    assert check(spark, site, points=9000, seconds=0.0)["positron"]["batches"] == 1


def test_faults_are_counted(spark, site):
    def height(head, q, data):
        q[100, 100] += 2
        return packed(head, q)

    undo = poke(site, height)
    r = check(spark, site)
    assert r["electron"]["photons"] == 1 and r["electron"]["worst"][0]["x"] == 400100 and r["electron"]["max_err_m"] > 0.01 and r["edges"]["photons"] == 0
    undo()

    def edge(head, q, data):
        q[50, 256] += 1
        return packed(head, q)

    undo = poke(site, edge)
    e = check(spark, site)["edges"]
    assert e["photons"] == 1 and (e["cases"][0]["side"], e["cases"][0]["sample"], e["cases"][0]["a_cm"] - e["cases"][0]["b_cm"]) == ("east", 50, 1)
    undo()

    undo = poke(site, lambda head, q, data: data[:28] + (5).to_bytes(4, "little") + data[32:])
    h = check(spark, site)["header"]
    assert h["photons"] == 1 and h["cases"][0]["nodata_count"] == 5
    undo()

    def hole(head, q, data):
        q[10, 10] = 0xFFFF
        return packed(head, q)

    undo = poke(site, hole)
    r = check(spark, site)
    assert r["electron"]["nodata_mismatch"] == 1 and r["electron"]["photons"] == 1 and r["header"]["photons"] == 0
    undo()


def test_source_reads_tiles(spark, site):
    spark.dataSource.register(HeightTiles)
    rows = spark.read.format("ght").load(str(site[0]))
    assert rows.count() == 4 * 257**2 and rows.where("z IS NULL OR isnan(z)").count() == 0
    with pytest.raises(Exception, match="no .ght tiles"):
        spark.read.format("ght").load(str(site[0] / "nothing")).count()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 10 and set(e.oracle_sql()) <= set(e.queries())


def test_oracles_agree_on_the_smallest_tables(spark):
    """Every elevation query against its SQL."""
    import os

    import duckdb

    from upland.plans.queries import QUERIES, SQL

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for f in os.listdir(d):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{d}/{f}')")
    clean = lambda v: repr(round(float(v), 6) + 0.0) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else repr(v)
    for name in SQL:
        got = QUERIES[name](spark, d)
        cols = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({SQL[name]})").fetchall()
        mine = [tuple(r) for r in got.select(*cols).collect()]
        assert sorted(tuple(map(clean, r)) for r in mine) == sorted(tuple(map(clean, r)) for r in want), name
    assert lattice(spark, 2, 3).count() == 6
