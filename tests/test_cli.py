import json

import numpy as np
from pyspark.sql import functions as F

from upland.plans import cli, runs
from upland.sources import rasters


def test_jobs(spark, tmp_path, capsys):
    y, x = np.mgrid[0:257, 0:257].astype(float)
    z = np.round(120 + 5 * np.sin(x / 60) * np.cos(y / 50) + 0.02 * x, 2)
    np.save(tmp_path / "source.npy", z)
    (tmp_path / "source.json").write_text(json.dumps({"origin_e_m": 400000, "origin_n_m": 300000, "spacing_m": 1.0, "rows": "south-to-north"}))
    spark.dataSource.register(rasters.NumpyGrid)
    grid = spark.read.format("npygrid").load(str(tmp_path / "source.npy"))
    runs.cut_site(grid, 257, 257, (400000, 300000), str(tmp_path), "site")
    assert cli.main(["verify", "--tiles", str(tmp_path), "--source", str(tmp_path / "source.npy"), "--points", "500"]) == 0
    receipt = json.loads((tmp_path / "pair_receipt.json").read_text())
    assert receipt["photons_total"] == 0 and json.loads((tmp_path / "tiles.json").read_text())["receipt"]["file"] == "pair_receipt.json"
    assert cli.main(["slope", "--site", str(tmp_path)]) == 0
    assert len(json.loads((tmp_path / "slope-tiles.json").read_text())["tiles"]) == 1
    assert cli.main(["earthworks", "--tiles", str(tmp_path), "--trenches", "3"]) == 0
    assert json.loads((tmp_path / "earthworks_receipt.json").read_text())["counts"]["trenches"] == 3
    cables = {"cables": [{"id": "b-33", "voltage_kv": 33, "csa_mm2": 1000, "od_mm": 70, "od_status": "verified"}, {"id": "d-132", "voltage_kv": 132, "csa_mm2": 1000, "od_mm": 91, "od_status": "verified"}], "rules": [{"voltage_kv": kv, "construction": "c", "when": "installation", "multiple_of_od": m, "source": "s"} for kv, m in ((33, 20), (132, 35), (33, None))]}
    (tmp_path / "cables.json").write_text(json.dumps(cables))
    assert cli.main(["cables", "--tiles", str(tmp_path), "--routes", "4", "--cables", str(tmp_path / "cables.json")]) == 0
    assert set(json.loads((tmp_path / "cable_sweep_receipt.json").read_text())["bend_rules"]) == {"33kV", "132kV"}
    spoilt = sorted((tmp_path / "tiles").glob("*.ght"))[0]
    spoilt.write_bytes(spoilt.read_bytes()[:-2] + b"\x07\x00")
    assert cli.main(["verify", "--tiles", str(tmp_path), "--points", "100"]) == 1
    assert grid.where(F.isnan("z")).count() == 0 and "photons" in capsys.readouterr().out
