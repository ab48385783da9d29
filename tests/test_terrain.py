import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from upland.functions import scalars as S
from upland.operators import terrain
from upland.operators.grid import lattice
from upland.plans import runs


def grid(spark, n, z, hole=None):
    g = lattice(spark, n, n).withColumn("z", z)
    return g.withColumn("z", F.when((F.col("r") != hole[0]) | (F.col("c") != hole[1]), F.col("z"))) if hole else g


def plane(spark, pe, pn, n=65, hole=None):
    return grid(spark, n, 100 + pe * F.col("c") + pn * F.col("r"), hole)


def test_plane_has_one_slope_and_no_photons(spark):
    receipt, classes = runs.slope_run(plane(spark, 0.072, 0.096))
    assert receipt["photons"] == 0 and receipt["valid"] == 63 * 63 and receipt["witness"]["photons"] == 0
    assert abs(receipt["electron"]["mean_pct"] - 12) < 1e-4 and abs(receipt["positron"]["max_pct"] - 12) < 1e-3
    inner = classes.where("r BETWEEN 1 AND 63 AND c BETWEEN 1 AND 63")
    assert {r.cls for r in inner.select("cls").distinct().collect()} == {3}
    assert {r.cls for r in classes.where("r = 0 OR c = 64").select("cls").distinct().collect()} == {255}


def test_class_edges(spark):
    want = {0.0: 0, 1.99: 0, 2.001: 1, 4.9: 1, 5.001: 2, 9.99: 2, 10.0: 3, 15.001: 4, 24.9: 4, 25.001: 5, 80.0: 5, 2.0: 1, 25.0: 5, None: 255}
    frame = spark.createDataFrame([(k,) for k in want], "s double").withColumn("cls", S.slope_class(F.col("s")))
    assert {r.s: r.cls for r in frame.collect()} == want


@pytest.mark.parametrize("pe,pn,octant", [(0, -0.1, 0), (-0.1, -0.1, 1), (-0.1, 0, 2), (-0.1, 0.1, 3), (0, 0.1, 4), (0.1, 0.1, 5), (0.1, 0, 6), (0.1, -0.1, 7), (0.001, 0, 8)])
def test_aspects(spark, pe, pn, octant):
    got = terrain.classes(plane(spark, pe, pn, 5)).where("r = 2 AND c = 2").first()
    assert got.asp == octant


def test_crease_photons_lie_on_breaks(spark):
    g = grid(spark, 65, 50 + 0.2 * F.greatest(F.col("r") + F.col("c") - 64, F.lit(0)).cast("double"))
    receipt, _ = runs.slope_run(g)
    s = terrain.breaks(terrain.slopes(g)).where("photon")
    assert {abs(r.d) for r in s.select((F.col("r") + F.col("c") - 64).alias("d")).collect()} == {1}
    b = receipt["breaks"]
    assert receipt["photons"] and b["photons_within_1m_of_top5pct_curvature"] == receipt["photons"] and b["by_chance"] < 0.1
    assert len(receipt["worst"]) == 8 and receipt["hot_16m_cells"][0]["photons"] >= receipt["hot_16m_cells"][-1]["photons"]


def test_hole_spreads_to_neighbours_only(spark):
    c = {(r.r, r.c): r for r in terrain.classes(plane(spark, 0.05, 0, hole=(20, 20))).collect()}
    assert c[20, 21].cls == c[19, 19].cls == c[21, 21].asp == 255 and c[20, 23].cls != 255
    assert c[20, 20].cls != 255  # the node itself isn't used by its own gradient
    s = terrain.breaks(terrain.slopes(plane(spark, 0.05, 0, hole=(20, 20))))
    assert s.where("isnan(curvature) OR isnan(horn_pct)").count() == 0 and s.first()["cut"] is not None


def test_no_photons_gives_none_in_worst(spark):
    receipt, _ = runs.slope_run(plane(spark, 0.0, 0.0, 9), with_witness=False)
    assert receipt["worst"] == [] and receipt["breaks"]["share_on_breaks"] is None


def test_shares_and_slope_tiles(spark, tmp_path):
    g = grid(spark, 513, 100 + 10 * F.sin(F.col("c") / 40) * F.cos(F.col("r") / 55))
    classes = terrain.classes(g).persist()
    index = runs.write_slope_tiles(classes, 513, 513, (400000, 300000), str(tmp_path), "waves", clock=lambda: "t")
    assert [t["key"] for t in index["tiles"]] == ["0_0", "1_0", "0_1", "1_1"]
    from upland.sources.tiles import ClassTiles, unpack_classes

    tiles = {t["key"]: unpack_classes((tmp_path / t["file"]).read_bytes()) for t in index["tiles"]}
    for t in index["tiles"]:
        head, cls, _ = tiles[t["key"]]
        assert head["steep_count"] == t["steep"] == int(((cls >= 3) & (cls != 255)).sum()) and abs(sum(t["share"]) - 1) < 1e-4
        assert head["nodata_count"] == int((cls == 255).sum()) and head["origin_e_m"] == t["e0"]
    assert (tiles["0_0"][1][:, -1] == tiles["1_0"][1][:, 0]).all() and (tiles["0_0"][2][-1] == tiles["0_1"][2][0]).all()
    spark.dataSource.register(ClassTiles)
    assert spark.read.format("gst").load(str(tmp_path)).count() == 4 * 257 * 257
    with pytest.raises(ValueError):
        unpack_classes((tmp_path / index["tiles"][0]["file"]).read_bytes()[:-1])
    classes.unpersist()


def test_witness_is_another_plan(spark):
    g = grid(spark, 40, 100 + 3 * F.sin(F.col("c") * 0.7) + 2 * F.cos(F.col("r") * 0.9), hole=(5, 5))
    w = terrain.witness_counts(terrain.slopes(g), terrain.witness(g)).first()
    assert w.horn_max_diff < 1e-9 and w.rook_max_diff < 1e-9 and w.class_mismatch == 0 and w.photons_witness <= w.photons_plan
    plan = terrain.witness(g)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and math.isfinite(w.horn_max_diff)


def test_exact_quantile(spark, monkeypatch):
    rng = np.random.default_rng(3)
    for values in (rng.lognormal(0, 3, 5000), np.round(rng.standard_normal(3000), 1), np.array([1.0, 2.0]), np.array([5.0] * 400 + [7.0] * 21), np.array([3.0]), np.repeat([0.0, 1e-300, 1.0], 50)):
        frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
        for last in (100_000, 5):
            monkeypatch.setattr(terrain, "LAST_VALUES", last)
            for q in (0.0, 0.5, 0.95, 1.0):
                assert terrain.exact_quantile(frame, "x", q) == pytest.approx(np.quantile(values, q), rel=1e-12, abs=0), (len(values), last, q)
    assert terrain.exact_quantile(frame.where("x > 9"), "x", 0.5) is None


def test_halo_tiles_join_without_seams(spark):
    z = np.random.default_rng(4).standard_normal((20, 23))
    z[5, 6] = np.nan
    frame = spark.createDataFrame([(r, c, None if np.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(z)], "r int, c int, z double")
    whole, parts = (sorted(map(tuple, terrain.neighbours(frame, n).collect()), key=lambda x: x[:2]) for n in (256, 4))
    assert whole == parts and len(whole) == 18 * 21
    by = {x[:2]: x for x in whole}
    assert by[4, 6][2:] == tuple(None if np.isnan(v) else v for v in (z[4, 6], z[5, 5], z[5, 6], z[5, 7], z[4, 5], z[4, 7], z[3, 5], z[3, 6], z[3, 7]))
