"""Jobs for spark-submit: python -m upland.plans.cli build | verify | slope | earthworks | cables | fetch ...

The exit status is 0 only if no check found a disagreement.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from ..session import session, ship
from ..sources.coverage import Coverage, boxes
from ..sources.rasters import NumpyGrid, is_northward, load_catalogue, settings
from ..sources.tiles import decode_heights, tile_files
from . import runs
from .receipts import exit_status, note_in_manifest, write_receipt


def _source(spark, path: str):
    import numpy as np

    with open(os.path.splitext(path)[0] + ".json", encoding="utf-8") as f:
        found = json.load(f)
    e, n, spacing = settings(found)
    is_northward(found)
    spark.dataSource.register(NumpyGrid)
    return spark.read.format("npygrid").load(path), np.load(path, mmap_mode="r").shape, (e, n), spacing


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="upland")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("build")
    for name, kind in (("--name", str), ("--e", float), ("--n", float), ("--out", str), ("--cache", str), ("--url", str), ("--coverage", str)):
        b.add_argument(name, type=kind, required=True)
    b.add_argument("--size", type=int, default=2048)
    f = sub.add_parser("fetch")
    for name in ("e0", "e1", "n0", "n1"):
        f.add_argument(name, type=int)
    f.add_argument("cache")
    f.add_argument("--url", required=True)
    f.add_argument("--coverage", required=True)
    for job, most, count, seconds, batch in (("verify", "--points", 1 << 22, 20.0, 1 << 20), ("earthworks", "--trenches", 4000, 20.0, 250), ("cables", "--routes", 40_000, 60.0, 2000)):
        s = sub.add_parser(job)
        s.add_argument("--tiles", required=True)
        s.add_argument("--source")
        s.add_argument("--seed", type=int, default=runs.SEED)
        s.add_argument(most, dest="count", type=int, default=count)
        s.add_argument("--seconds", type=float, default=seconds)
        s.add_argument("--batch", type=int, default=batch)
        if job == "cables":
            s.add_argument("--cables", required=True)
    s = sub.add_parser("slope")
    s.add_argument("--site", required=True)
    s.add_argument("--out")
    a = p.parse_args(argv)

    if a.job == "fetch":
        for found in Coverage(a.url, a.coverage, a.cache).chunks(boxes(a.e0, a.e1, a.n0, a.n1)):
            print(*found)
        return 0
    spark = ship(session())
    if a.job == "build":
        print(json.dumps({k: v for k, v in runs.build_site(spark, a.name, a.e, a.n, a.size, a.out, a.cache, a.url, a.coverage).items() if k != "manifest"}, indent=1))
        return 0
    folder = a.site if a.job == "slope" else a.tiles
    grid, shape, origin, spacing = _source(spark, getattr(a, "source", None) or os.path.join(folder, "source.npy"))
    if a.job == "verify":
        tiles = tile_files(spark, folder)
        names = tiles.select("path", "tile").persist()
        rows = decode_heights(tiles, strict=False).join(runs._small(names, names.count()), "path")
        receipt = runs.verify_tiles(spark, rows, grid, shape, origin, spacing, points=a.count, seconds=a.seconds, batch=a.batch, seed=a.seed)
        path, photons = os.path.join(folder, "pair_receipt.json"), receipt["photons_total"]
    elif a.job == "slope":
        receipt, classes = runs.slope_run(grid, spacing, tuple(map(int, origin)))
        out = a.out or folder
        runs.write_slope_tiles(classes, *shape, tuple(map(int, origin)), out, os.path.basename(os.path.normpath(folder)), int(round(spacing * 1000)))
        path, photons = os.path.join(out, "slope_receipt.json"), receipt["witness"]["photons"]
    elif a.job == "earthworks":
        receipt = runs.earthworks_sweep(spark, grid, shape, origin, spacing, a.count, a.seconds, a.batch, a.seed)
        path, photons = os.path.join(folder, "earthworks_receipt.json"), receipt["photons_total"]
    else:
        parts = load_catalogue(spark, a.cables)
        receipt = runs.cable_sweep(spark, grid, shape, origin, *parts, spacing, a.count, a.seconds, a.batch, a.seed)
        path, photons = os.path.join(folder, "cable_sweep_receipt.json"), receipt["photons_total"]
    digest = write_receipt(path, receipt)
    if a.job == "verify":
        note_in_manifest(os.path.join(folder, "tiles.json"), path, digest)
    print(path, digest, f"{photons} photons")
    return exit_status(photons)


if __name__ == "__main__":
    sys.exit(main())
