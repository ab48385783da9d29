"""Binary tiles: layouts, codecs, and the data sources "ght" (heights) and "gst" (slope classes).

Both have a 32-byte little-endian header. The sources read one file per partition through Spark's own
listing of the driver, or take bytes from spark.read.format("binaryFile") with decode_heights() and
decode_classes(), which works for any file system that Spark reads.
"""

from __future__ import annotations

import glob
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: The layouts.
HEIGHT_HEAD, HEIGHT_MAGIC = struct.Struct("<4s4H3i2HI"), b"GGH1"
CLASS_HEAD, CLASS_MAGIC = struct.Struct("<4s4H2i2BH2I"), b"GGS1"
NO_HEIGHT, NO_CLASS, CLASSES, METHOD = 0xFFFF, 255, 6, 1

HEIGHT_FIELDS = "version int, samples int, spacing_mm int, flags int, origin_e_m int, origin_n_m int, base_cm int, min_q int, max_q int, nodata_count long"
CLASS_FIELDS = "version int, samples int, spacing_mm int, flags int, origin_e_m int, origin_n_m int, classes int, method int, nodata_count long, steep_count long"


def pack_heights(q: np.ndarray, base_cm: int, origin_e: int, origin_n: int, spacing_mm: int = 1000) -> bytes:
    """A height tile from a square of quantised heights, rows from the south."""
    valid = q[q != NO_HEIGHT]
    low, high = (int(valid.min()), int(valid.max())) if valid.size else (0, 0)
    head = HEIGHT_HEAD.pack(HEIGHT_MAGIC, 1, len(q), spacing_mm, 0, origin_e, origin_n, base_cm, low, high, q.size - valid.size)
    return head + np.ascontiguousarray(q, "<u2").tobytes()


def unpack_heights(data: bytes, strict: bool = True) -> tuple[dict, np.ndarray]:
    """Header and quantised heights. Not strict: only the magic is held against the data, and the body is its end."""
    if len(data) < HEIGHT_HEAD.size:
        raise ValueError("a height tile has 32 bytes at least")
    magic, *fields = HEIGHT_HEAD.unpack_from(data)
    head = dict(zip((f.split()[0] for f in HEIGHT_FIELDS.split(", ")), fields, strict=True))
    n = head["samples"]
    if magic != HEIGHT_MAGIC or (strict and head["version"] != 1):
        raise ValueError(f"not a height tile: {magic!r}, version {head['version']}")
    if strict and len(data) != HEIGHT_HEAD.size + 2 * n * n:
        raise ValueError(f"a height tile of {n} samples a side has {HEIGHT_HEAD.size + 2 * n * n} bytes, this one {len(data)}")
    head["header_bytes"] = len(data) - 2 * n * n
    return head, np.frombuffer(data, "<u2", n * n, head["header_bytes"]).reshape(n, n)


def pack_classes(cls: np.ndarray, asp: np.ndarray, origin_e: int, origin_n: int, spacing_mm: int = 1000) -> bytes:
    if cls.shape != asp.shape or cls.shape[0] != cls.shape[1]:
        raise ValueError("classes and aspects must be squares of one size")
    valid = cls != NO_CLASS
    head = CLASS_HEAD.pack(CLASS_MAGIC, 1, len(cls), spacing_mm, 0, origin_e, origin_n, CLASSES, METHOD, 0, int((~valid).sum()), int((valid & (cls >= 3)).sum()))
    return head + cls.astype(np.uint8).tobytes() + asp.astype(np.uint8).tobytes()


def unpack_classes(data: bytes) -> tuple[dict, np.ndarray, np.ndarray]:
    if len(data) < CLASS_HEAD.size:
        raise ValueError("a class tile has 32 bytes at least")
    magic, version, n, spacing, flags, e, north, classes, method, _, nodata, steep = CLASS_HEAD.unpack_from(data)
    if magic != CLASS_MAGIC or version != 1:
        raise ValueError(f"not a class tile: {magic!r}, version {version}")
    if len(data) != CLASS_HEAD.size + 2 * n * n:
        raise ValueError(f"a class tile of {n} samples a side has {CLASS_HEAD.size + 2 * n * n} bytes, this one {len(data)}")
    body = np.frombuffer(data, np.uint8, offset=CLASS_HEAD.size).reshape(2, n, n)
    return dict(version=version, samples=n, spacing_mm=spacing, flags=flags, origin_e_m=e, origin_n_m=north, classes=classes, method=method, nodata_count=nodata, steep_count=steep), body[0], body[1]


def encode_heights(tiles: DataFrame, samples: int = 257, origin_e: int = 0, origin_n: int = 0, spacing_mm: int = 1000) -> DataFrame:
    """ix, iy, e0, n0, data of quantised tiles (ix, iy, i, j, base_cm, q); nodes without a row have no height."""
    step = (samples - 1) * spacing_mm // 1000

    def work(t: pa.Table) -> pa.Table:
        ix, iy = t.column("ix")[0].as_py(), t.column("iy")[0].as_py()
        q = np.full((samples, samples), NO_HEIGHT, np.uint16)
        q[t.column("i").to_numpy(), t.column("j").to_numpy()] = t.column("q").to_numpy()
        e, n = origin_e + ix * step, origin_n + iy * step
        return pa.table({"ix": pa.array([ix], pa.int32()), "iy": pa.array([iy], pa.int32()), "e0": pa.array([e], pa.int32()), "n0": pa.array([n], pa.int32()), "data": [pack_heights(q, t.column("base_cm")[0].as_py(), e, n, spacing_mm)]})

    return tiles.select("ix", "iy", "i", "j", F.col("base_cm").cast("long"), F.col("q").cast("int")).groupBy("ix", "iy").applyInArrow(work, "ix int, iy int, e0 int, n0 int, data binary")


def encode_classes(tiles: DataFrame, samples: int = 257, origin_e: int = 0, origin_n: int = 0, spacing_mm: int = 1000) -> DataFrame:
    """ix, iy, e0, n0, data of tiles (ix, iy, i, j, cls, asp)."""
    step = (samples - 1) * spacing_mm // 1000

    def work(t: pa.Table) -> pa.Table:
        ix, iy = t.column("ix")[0].as_py(), t.column("iy")[0].as_py()
        cls, asp = np.full((2, samples, samples), NO_CLASS, np.uint8)
        at = t.column("i").to_numpy(), t.column("j").to_numpy()
        cls[at], asp[at] = t.column("cls").to_numpy(), t.column("asp").to_numpy()
        e, n = origin_e + ix * step, origin_n + iy * step
        return pa.table({"ix": pa.array([ix], pa.int32()), "iy": pa.array([iy], pa.int32()), "e0": pa.array([e], pa.int32()), "n0": pa.array([n], pa.int32()), "data": [pack_classes(cls, asp, e, n, spacing_mm)]})

    return tiles.select("ix", "iy", "i", "j", F.col("cls").cast("int"), F.col("asp").cast("int")).groupBy("ix", "iy").applyInArrow(work, "ix int, iy int, e0 int, n0 int, data binary")


def _height_batch(name: str, data: bytes, strict: bool) -> pa.RecordBatch:
    head, q = unpack_heights(data, strict)
    n = head["samples"]
    i, j = np.divmod(np.arange(n * n, dtype=np.int32), np.int32(n))
    flat = q.ravel().astype(np.int32)
    missing = flat == NO_HEIGHT
    z = pa.array((head["base_cm"] + flat) / 100.0, mask=missing)
    same = {k: pa.array(np.full(n * n, v, np.int64 if k == "nodata_count" else np.int32)) for k, v in head.items()}
    return pa.RecordBatch.from_pydict({"path": pa.array([name] * (n * n)), "i": i, "j": j, "q": flat, "z": z} | same)


def _class_batch(name: str, data: bytes) -> pa.RecordBatch:
    head, cls, asp = unpack_classes(data)
    n = head["samples"]
    i, j = np.divmod(np.arange(n * n, dtype=np.int32), np.int32(n))
    same = {k: pa.array(np.full(n * n, v, np.int64 if k.endswith("_count") else np.int32)) for k, v in head.items()}
    return pa.RecordBatch.from_pydict({"path": pa.array([name] * (n * n)), "i": i, "j": j, "cls": cls.ravel().astype(np.int32), "asp": asp.ravel().astype(np.int32)} | same)


HEIGHT_ROWS = f"path string, i int, j int, q int, z double, {HEIGHT_FIELDS}, header_bytes int"
CLASS_ROWS = f"path string, i int, j int, cls int, asp int, {CLASS_FIELDS}"


def decode_heights(files: DataFrame, strict: bool = True) -> DataFrame:
    """A row per sample of files (path, content)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield _height_batch(name, data, strict)

    return files.select("path", "content").mapInArrow(work, HEIGHT_ROWS)


def decode_classes(files: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield _class_batch(name, data)

    return files.select("path", "content").mapInArrow(work, CLASS_ROWS)


def tile_files(spark, path: str, suffix: str = ".ght") -> DataFrame:
    """path, content, tile (its place among the sorted paths) of all tiles under a folder.

    Paths are numbered by range partitions: a partition's count of paths, which are few numbers, gives where the next begins.
    Contents take no part in it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path).select("path", "content")
    names = files.select("path").repartitionByRange("path").withColumn("part", F.spark_partition_id()).persist()
    counts = [r for r in names.groupBy("part").count().orderBy("part").collect()]  # a row for each partition
    starts, at = [], 0
    for r in counts:
        starts.append((r["part"], at))
        at += r["count"]
    first = F.broadcast(spark.createDataFrame(starts, "part int, first long"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("path")) - 1
    numbered = names.withColumn("own", own).join(first, "part").select("path", (F.col("first") + F.col("own")).cast("int").alias("tile"))
    return files.join(numbered, "path")


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, heights: bool):
        self.root, self.heights = options["path"], heights
        self.strict = options.get("mode", "strict") != "lenient"

    def partitions(self) -> list[InputPartition]:
        suffix = "ght" if self.heights else "gst"
        found = [self.root] if os.path.isfile(self.root) else sorted(glob.glob(os.path.join(glob.escape(self.root), "**", f"*.{suffix}"), recursive=True))
        if not found:
            raise FileNotFoundError(f"no .{suffix} tiles under {self.root}")
        return [_File(f) for f in found]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        with open(partition.value, "rb") as f:
            data = f.read()
        yield _height_batch(partition.value, data, self.strict) if self.heights else _class_batch(partition.value, data)


class HeightTiles(DataSource):
    """spark.read.format("ght").option("mode", "lenient").load(folder); spark.dataSource.register(HeightTiles) first."""

    @classmethod
    def name(cls) -> str:
        return "ght"

    def schema(self) -> StructType | str:
        return HEIGHT_ROWS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, True)


class ClassTiles(DataSource):
    """spark.read.format("gst").load(folder)."""

    @classmethod
    def name(cls) -> str:
        return "gst"

    def schema(self) -> StructType | str:
        return CLASS_ROWS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, False)
