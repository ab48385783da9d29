"""Shared helpers: tables, the shared folder, word hashing, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only characters that end a word.
SPACE = r"[\x20\x09-\x0D]"
#: Rows and bytes of a batch handed to Python; a text can be long, so the bytes count.
BATCH_ROWS, BATCH_BYTES = 1024, 3 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of this machine where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = f"file://{os.path.join(tempfile.gettempdir(), 'upland-shared')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Spark's own setting to let go of an action's shuffle files when it has ended.
LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the finished job are let go, so the disk holds the table only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/upland-{uuid.uuid4().hex}"
    before = spark.conf.get(LET_GO, "false")
    spark.conf.set(LET_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(LET_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, as a lambda's argument."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, in their order; empty for fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for i in range(1, k):
            out = mix(out) * MIX + words[i : n + i]
        return mix(out)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def plain(docs: DataFrame, *names: str) -> DataFrame:
    """doc_id and text as bytes (null stays null); extra columns don't reach Python."""
    return docs.select(F.col("doc_id"), F.col("text").cast("binary").alias("text"), *names)


#: Keys that join_counted broadcasts, at most.
HEAVY = 10_000


def join_counted(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """left joined with right, which holds a key once and in n how many rows of left have it.

    Keys with more than the HEAVY-th part of all those rows are HEAVY at most: they are broadcast, so their
    rows stay where they are; the others are joined by shuffling, where no key holds more than that part.
    how is inner or left; left and right are read twice and should be tables.
    """
    total = right.agg(F.sum("n")).first()[0] or 0
    heavy = F.broadcast(right.where(F.col("n") > total // HEAVY))
    rest = left.join(heavy.select(*on), on, "left_anti").join(right.where(F.col("n") <= total // HEAVY).hint("merge"), on, how)
    return left.join(heavy, on).unionByName(rest)


#: Edges whose components one task works out, at most; it holds some 100 bytes for each.
FEW_EDGES = 2_000_000


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges (a, b) and, for each, the least node reachable."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:  # every label is a root; roots of an edge go to the lesser one, then all paths are followed to their end
        x, y = label[u], label[v]
        if (x == y).all():
            return nodes, nodes[label]
        least = label.copy()
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least != (after := least[least])).any():
            least = after
        label = least[label]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node long, label long): the least node reachable, for each node of the undirected edges.

    Up to FEW_EDGES edges go to one task, so few edges don't cost a series of jobs. With more, every round takes the least
    label among neighbours, then follows labels one hop, so long chains halve; a round's labels are a table in the shared folder.
    """
    own = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    own = materialize(own.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    if own.count() <= FEW_EDGES:

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                u, v = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1))
                found = [pa.array(x) for x in least_labels(u, v)]
                yield from pa.Table.from_arrays(found, ["node", "label"]).to_batches(BATCH_ROWS)

        return materialize(own.coalesce(1).mapInArrow(work, "node long, label long"))
    both = materialize(own.union(own.select("v", "u")))
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        least = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        after = materialize(least.join(hop, least.label == hop.at, "left").select("node", "before", F.least("label", F.coalesce("next", "label")).alias("label")))
        moved = after.where("before <> label").limit(1).count()
        labels = after.select("node", "label")
        if not moved:
            return labels
