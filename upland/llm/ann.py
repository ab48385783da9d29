"""Nearest neighbours by multi-index hashing.

Codes: vectors are scaled to length 1 and given BITS bits, about, by learned rotations (iterative quantisation
of the centred sample, each from its own random start). For the largest inner product the scaled vector gets
one more component, sqrt(1 - |x|^2 / R^2) with R the largest norm, so that the nearest in angle has the
largest inner product.

Index: a code is split into substrings of 20 to 24 bits, log2(rows) if between, each with a table of its own. Codes within Hamming
radius r of a query differ by at most (r - i) // substrings bits in some substring i (pigeonhole), so the buckets
within that distance of the query's substrings, found by enumerating their keys (or by going through the keys that a
part has, if these are fewer), hold all of them. Everything in these buckets is reranked, once, by inner products of the original vectors in double precision.

The radius is the least with which the buckets hold READY of a sample's true nearest neighbours; sample and
queries of the fit are bounded (FIT_ROWS rows of least hashes, FIT_QUERIES), the index holds every row. A query
that finds fewer than k rows goes on with a wider radius until it has them.

A table's rows go to tasks by the first bits of the substring, and by salt where these are common, BLOCK rows a
task; the index is shuffled once, a copy for each table. A query goes to the tasks whose first bits are within reach.

Equal vectors are one entry with the k + 1 least ids, which are all that can be among the k nearest of any
query, and queries of equal vectors are searched once; so a vector that a third of all rows hold is one entry.

Defined cases: vectors that are null, zero, of another dimension than most, or hold null or non-finite
components take no part; rows without id neither; of rows that share an id the least vector counts, so neighbours
are different ids; ties go to the smaller id; equal vectors are neighbours like others; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, join_counted, materialize, small_batches

BITS, LEAST_SUBSTRING, MOST_SUBSTRING = 160, 20, 24
FIT_ROWS, FIT_QUERIES, READY = 20_000, 200, 0.925
BLOCK = 32_768


def learn_rotation(x: np.ndarray, bits: int, seed: int, rounds: int = 30) -> np.ndarray:
    """Iterative quantisation: the rotation of x (rows) that is nearest to its signs."""
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(x @ turn).T @ x)
        turn = (u @ v).T
    return turn[:, :bits]


class Codes:
    """What the fit has learnt: largest norm, mean, rotations, radius. Codes are rows of substrings, a number each."""

    def __init__(self, sample: np.ndarray, top_norm: float, k: int, rows: int):
        self.top_norm = top_norm
        self.width = int(np.clip(np.ceil(np.log2(max(rows, 2))), LEAST_SUBSTRING, MOST_SUBSTRING))
        self.tables = max(2, round(BITS / self.width))
        wide = self._wide(sample)
        self.mean = wide.mean(axis=0)
        bits, size = self.tables * self.width, wide.shape[1]
        self.turns = [learn_rotation(wide - self.mean, min(size, bits - at), seed) for seed, at in enumerate(range(0, bits, size), 1)]
        asked = np.arange(0, len(sample), max(1, len(sample) // FIT_QUERIES))
        score = sample[asked] @ sample.T
        score[np.arange(len(asked)), asked] = -np.inf
        near = np.argsort(-score, axis=1, kind="stable")[:, : min(k, max(1, len(sample) - 1))]
        codes = self.encode(sample)
        # the least radius whose buckets hold each neighbour: table i is reached from a radius of its distance * tables + i on
        apart = np.bitwise_count(codes[near] ^ codes[asked][:, None]).astype(np.int64) * self.tables + np.arange(self.tables)
        self.radius = int(np.quantile(apart.min(axis=2), READY, method="higher"))

    def reach(self, radius: int) -> np.ndarray:
        """Bits by which a substring of each table may differ."""
        return (radius - np.arange(self.tables)) // self.tables

    @property
    def whole(self) -> int:
        """A radius that reaches every code."""
        return self.tables * (self.width + 1)

    def _wide(self, x: np.ndarray) -> np.ndarray:
        x = x / self.top_norm
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])

    def encode(self, x: np.ndarray) -> np.ndarray:
        bits = np.hstack([(self._wide(x) - self.mean) @ t for t in self.turns]) > 0
        return (bits.reshape(len(x), self.tables, self.width) @ (1 << np.arange(self.width))).astype(np.uint32)


@cache
def masks(bits: int, most: int) -> np.ndarray:
    """All numbers of so many bits with at most `most` ones."""
    every = np.arange(1 << bits, dtype=np.uint32)
    return every[np.bitwise_count(every) <= most]


class Buckets:
    """One table's part: rows whose substrings begin with the same bits, found by the others, `low` bits each."""

    def __init__(self, codes: np.ndarray, table: int, low: int):
        self.codes, self.table, self.low = codes, table, low
        keys = codes[:, table] & np.uint32((1 << low) - 1)
        self.order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[self.order], return_index=True)
        self.first = np.append(first, len(keys))

    def within(self, code: np.ndarray, start: int, reach: np.ndarray) -> np.ndarray:
        """Rows within reach of the code by this table, but for those that an earlier table reaches; start: their first bits."""
        left = int(reach[self.table]) - int(np.bitwise_count((code[self.table] >> self.low) ^ np.uint32(start)))
        if left < 0:
            return self.order[:0]
        own, near = code[self.table] & np.uint32((1 << self.low) - 1), masks(self.low, min(left, self.low))
        if len(near) < len(self.keys):
            asked = own ^ near
            at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            at = at[self.keys[at] == asked]
        else:
            at = np.flatnonzero(np.bitwise_count(self.keys ^ own) <= left)
        a, b = self.first[at], self.first[at + 1]
        ends = np.cumsum(b - a)
        rows = self.order[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(a - (ends - (b - a)), b - a)]
        before = self.table
        earlier = (np.bitwise_count(self.codes[rows, :before] ^ code[:before]) <= reach[:before]).any(axis=1)
        return rows[~earlier]


def rerank(ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k nearest, nearest first."""
    if len(rows) > 4 * k:
        rough = vectors[rows] @ vector
        # sums of another order may differ in the last digits
        rows = rows[rough >= np.partition(rough, -k)[-k] - 1e-9 * max(1.0, float(np.abs(rough).max()))]
    score = (vectors[rows] * vector).sum(axis=1)
    best = np.lexsort((ids[rows], -score))[:k]
    return rows[best], score[best]


def _vectors(batch: pa.RecordBatch | pa.Table, name: str = "v") -> np.ndarray:
    flat = batch.column(name)
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    found = flat.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return found.astype(np.float64) if found.dtype == np.float32 else found


def _encoded(rows: DataFrame, codes: Codes) -> DataFrame:
    """rows with their code."""
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = codes.encode(_vectors(b)) if b.num_rows else np.empty((0, codes.tables), np.uint32)
            at = pa.array(np.arange(b.num_rows + 1) * codes.tables, pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(at, pa.array(code.astype(np.int64).ravel()))], [*names, "code"])

    return rows.mapInArrow(work, ", ".join(f"{x} {t}" for x, t in rows.dtypes) + ", code array<long>")


def _probe(index: DataFrame, parts: DataFrame, asked: DataFrame, codes: Codes, radius: int, low: int, k: int) -> DataFrame:
    """head (of the query), entry, ids, score: the k nearest entries of every part that a query reaches.
    index: t, start, salt, entry, ids, v, code; parts: to_t, to_start, to_salt of all parts; asked: head, v, code."""
    reach = codes.reach(radius)
    high = codes.width - low

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, tables, starts = [], [], []
            for i, code in enumerate(column(b, "code")):
                for t, r in enumerate(reach.tolist()):
                    if r >= 0:
                        found = np.uint32(code[t] >> low) ^ masks(high, min(r, high))
                        starts.append(found.astype(np.int32))
                        tables.append(np.full(len(found), t, np.int32))
                        rows.append(np.full(len(found), i))
            at = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns), pa.array(np.concatenate(tables) if rows else [], pa.int32()), pa.array(np.concatenate(starts) if rows else [], pa.int32())], [*b.schema.names, "t", "start"])

    sent = asked.select("head", "v", "code").mapInArrow(routes, f"head long, v {dict(asked.dtypes)['v']}, code array<long>, t int, start int")
    sent = sent.join(parts, (F.col("t") == F.col("to_t")) & (F.col("start") == F.col("to_start"))).drop("t", "start")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            entry, vectors = left.column("entry").to_numpy(), _vectors(left)
            own = _vectors(left, "code").astype(np.uint32)
            start = left.column("start")[0].as_py()
            buckets = Buckets(own, left.column("t")[0].as_py(), low)
            for head, vector, code in zip(right.column("head").to_pylist(), _vectors(right), _vectors(right, "code").astype(np.uint32), strict=True):
                rows = buckets.within(code, start, reach)
                if len(rows):
                    out.append((head, *rerank(entry, vectors, rows, vector, k)))
        rows = np.concatenate([x[1] for x in out]) if out else np.empty(0, np.int64)
        found = left.select(["entry", "ids"]).take(pa.array(rows))
        heads = np.repeat(np.array([x[0] for x in out], np.int64), [len(x[1]) for x in out])
        return pa.table({"head": pa.array(heads), "entry": found.column("entry"), "ids": found.column("ids"), "score": pa.array(np.concatenate([x[2] for x in out]) if out else np.empty(0))})

    return index.groupBy("t", "start", "salt").cogroup(sent.groupBy("to_t", "to_start", "to_salt")).applyInArrow(work, "head long, entry long, ids array<long>, score double")


def search(table: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by `every`, against all rows."""
    spark = table.sparkSession
    small_batches(spark)
    shape = "query_id long, rank int, vec_id long, score double"
    # kept as floats if they are, which is half the size; all sums are in double precision
    vector = F.col("embedding") if dict(table.dtypes)["embedding"] == "array<float>" else F.col("embedding").cast("array<double>")
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = table.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(sound).select("vec_id", vector.alias("v"))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if not dims:
        return spark.createDataFrame([], shape)
    rows = materialize(rows.where(F.size("v") == dims["d"]).groupBy("vec_id").agg(F.min("v").alias("v")))

    # entries: a vector with its k + 1 least ids; the window's limit is applied before the shuffle as well
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = materialize(kept.select(F.col("ids")[0].alias("entry"), "ids", "v"))
    total, top = entries.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()
    picked = entries.orderBy(F.xxhash64("entry", F.lit(7)), "entry").limit(FIT_ROWS)
    codes = Codes(np.array([r["v"] for r in picked.select("v").collect()], np.float64), top, k, total)

    # queries: one for each vector that has any; head is the vector's entry
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    per_vector = queries.groupBy("v").agg(F.count("*").alias("n")).join(entries.select("v", F.col("entry").alias("head")), "v")
    heads = _encoded(per_vector.select("head", "v", "n"), codes)
    heads = materialize(heads)

    # parts: a substring's first bits, salted where they are common
    high = int(np.clip(np.ceil(np.log2(max(1, total / BLOCK))), 0, codes.width))
    low = codes.width - high
    coded = materialize(_encoded(entries, codes))
    spread = coded.select("entry", "ids", "v", "code", F.posexplode("code").alias("t", "sub")).withColumn("start", F.shiftright("sub", low).cast("int")).drop("sub")
    sizes = spread.groupBy("t", "start").agg(F.count("*").alias("n"))
    sizes, salts = materialize(sizes), F.ceil(F.col("n") / BLOCK).cast("int")
    index = join_counted(spread, sizes, ["t", "start"]).withColumn("salt", F.pmod(F.xxhash64("entry"), salts).cast("int")).drop("n")
    parts = sizes.select(F.col("t").alias("to_t"), F.col("start").alias("to_start"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("to_salt"))

    radius, waiting, found = codes.radius, heads, None
    while True:
        near = _probe(index, parts, waiting, codes, radius, low, k + 1)
        nth = F.row_number().over(Window.partitionBy("head").orderBy(F.desc("score"), "entry"))
        near = near.withColumn("nth", nth).where(F.col("nth") <= k + 1).select("head", "score", F.explode("ids").alias("vec_id"))
        nth = F.row_number().over(Window.partitionBy("head").orderBy(F.desc("score"), "vec_id"))
        best = near.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("head").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("best"))
        best = materialize(best)
        if radius >= codes.whole:
            found = best if found is None else found.unionByName(best)
            break
        done = best.where(F.size("best") > k)
        found = done if found is None else found.unionByName(done)
        waiting = waiting.join(done.select("head"), "head", "left_anti")
        if waiting.isEmpty():
            break
        radius = min(radius + 2 * codes.tables, codes.whole)

    answers = materialize(found.join(heads.select("head", "v", "n"), "head").select("v", "n", "best"))
    own = join_counted(queries, answers, ["v"])
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    each = own.withColumnRenamed("vec_id", "query_id").select("query_id", F.posexplode(others).alias("at", "x"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score"))
