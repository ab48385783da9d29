"""Best-fit packing by exact complements.

Documents become ids, longer ones are cut into pieces of `room` ids (the first piece may be
shorter), and the pieces are placed in sequences of at most `room` ids.

A plan needs the histogram of lengths only, which has `room` entries at any size of the corpus. An index holds the
sums of one, two and three lengths still available: which lengths there are, by how many pairs each sum is
reached, and triples as a length and a pair's sum. Going down from the longest, a length's gap is filled exactly by a
single, else a pair, else a triple; a combination is used as often as its counts allow, and the index follows
when a length is used up. Residuals, which have no exact complement, are packed best fit, by the combination
that leaves least. They are packed at the end or, in a second plan, each as soon as it has no exact complement,
while short lengths are left; the plan with fewer sequences counts, the first if they are equal.
Each combination used up empties a length, so a plan has a few thousand lines.

Pieces find their place by their rank among those of equal length. Ranks are counted in buckets of a hash of
doc_id, as many for each length as it has RANKED pieces, and the counts of earlier buckets are added.

Defined cases: a null or empty text has the end id only; rows without doc_id and repeated rows are
packed like others; ties between combinations go to the longest length, then to the widest pair; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, materialize, plain, small_batches
from .tokens import let_go, shared_encoder, vocabulary

ROOM, END = 1024, 2
#: Pieces of one length and bucket that one task ranks, about.
RANKED = 500


class Sums:
    """Counts of lengths, and an index of the sums of one, two and three of them."""

    def __init__(self, counts: np.ndarray):
        self.have = counts.astype(np.int64).copy()
        self.top = len(counts) - 1
        self.single, self.double = np.zeros(self.top + 1, bool), np.zeros(self.top + 1, bool)  # there is one, there are two
        self.pairs = np.zeros(self.top + 1, np.int64)  # pairs that reach a sum
        for x in range(1, self.top + 1):
            self._follow(x)

    def _follow(self, x: int) -> None:
        """Bring the index up to date with the count of x."""
        one, two = bool(self.have[x] > 0), bool(self.have[x] > 1)
        if one != self.single[x]:
            self.single[x] = False
            others = np.flatnonzero(self.single[: self.top - x + 1])
            self.pairs[others + x] += 1 if one else -1
            self.single[x] = one
        if two != self.double[x]:
            self.double[x] = two
            if 2 * x <= self.top:
                self.pairs[2 * x] += 1 if two else -1

    def take(self, lengths: list[int]) -> int:
        """Use a combination as often as its counts allow, and say how often."""
        times = min(int(self.have[x]) // lengths.count(x) for x in set(lengths))
        for x in set(lengths):
            self.have[x] -= times * lengths.count(x)
            self._follow(x)
        return times

    def enough(self, lengths: list[int]) -> bool:
        return all(self.have[x] >= lengths.count(x) for x in set(lengths))

    def _pair(self, total: int, used: list[int]) -> list[int] | None:
        """Two lengths with this sum, as far apart as can be, that are there beside those in use."""
        if total < 2 or not self.pairs[total]:
            return None
        small = np.arange(1, total // 2 + 1)
        small = small[self.single[small] & self.single[total - small]]
        return next((p for x in small.tolist() if self.enough([*used, *(p := [total - x, x])])), None)

    def filling(self, gap: int, used: list[int]) -> list[int] | None:
        """One, two or three lengths that sum up to the gap and are there beside those in use; the longest first."""
        if gap == 0:
            return []
        if self.single[gap] and self.enough([*used, gap]):
            return [gap]
        if found := self._pair(gap, used):
            return found
        longest = np.arange(gap - 2, (gap + 2) // 3 - 1, -1)
        for x in longest[self.single[longest] & (self.pairs[gap - longest] > 0)].tolist():
            if found := self._pair(gap - x, [*used, x]):
                return [x, *found]
        return None


def _best_fit(sums: Sums, room: int, length: int) -> list[int]:
    """A sequence that begins with `length`: the combination that leaves least, and what still fits behind it."""
    gap = room - length
    found = next((f for fill in range(gap, 0, -1) if sums.single[: fill + 1].any() and (f := sums.filling(fill, [length]))), [])
    lengths = [length, *found]
    while True:
        gap = room - sum(lengths)
        fits = next((x for x in np.flatnonzero(sums.single[: gap + 1])[::-1].tolist() if sums.enough([*lengths, x])), None)
        if fits is None:
            return lengths
        lengths.append(fits)


def _planned(counts: np.ndarray, room: int, apart: bool) -> list[tuple[list[int], int]]:
    sums, out = Sums(counts), []
    for exact in (True, False) if apart else (False,):
        for length in range(room, 0, -1):
            while sums.have[length]:
                found = sums.filling(room - length, [length])
                if found is None and exact:
                    break  # lengths only get fewer, so it stays a residual
                lengths = _best_fit(sums, room, length) if found is None else [length, *found]
                out.append((lengths, sums.take(lengths)))
    return out


def plan(counts: np.ndarray, room: int = ROOM) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, sequences like it) for counts[length], until all are placed."""
    return min((_planned(counts, room, apart) for apart in (True, False)), key=lambda p: sum(times for _, times in p))


def places(planned: list[tuple[list[int], int]], room: int = ROOM) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, its sequence and the offset of each run of ranks."""
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(room + 1)]
    rank, sequence = [0] * (room + 1), 0
    for lengths, times in planned:
        offset = 0
        for x in lengths:
            runs[x].append((rank[x], sequence, offset))
            rank[x] += times
            offset += x
        sequence += times
    return [tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) if r else (np.empty(0, np.int64),) * 3 for r in runs]


def pieces(docs: DataFrame, tokenizer: str, end: int = END, room: int = ROOM) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces."""
    path = vocabulary(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with shared_encoder(path) as encoder:
            for b in batches:
                rows = []
                for doc, ids in zip(column(b, "doc_id"), encoder.texts(column(b, "text")), strict=True):
                    data = memoryview(np.append(ids, np.uint32(end)).astype("<u4").tobytes())
                    n = len(ids) + 1
                    first = (n - 1) % room + 1
                    for k, at in enumerate([0, *range(first, n, room)]):
                        size = first if k == 0 else room
                        rows.append((doc, k, at, size, zlib.crc32(data[4 * at : 4 * (at + size)])))
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return plain(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end: int = END, room: int = ROOM) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    small_batches(docs.sparkSession)
    cut = materialize(pieces(docs, tokenizer, end, room))
    counts = np.zeros(room + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most `room` rows
        counts[row["length"]] = row["count"]
    where = places(plan(counts, room), room)

    # at most `room` rows
    buckets = docs.sparkSession.createDataFrame([(x, int(n // RANKED) + 1) for x, n in enumerate(counts.tolist()) if n], "length long, buckets long")
    cut = cut.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.col("buckets")).cast("int"))
    each = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = each.select("length", "bucket", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = cut.withColumn("own", own).join(before.hint("merge"), ["length", "bucket"]).withColumn("rank", F.col("own") + F.coalesce("before", F.lit(0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                rows = np.flatnonzero(length == x)
                first, seq, off = where[x]
                i = np.searchsorted(first, rank[rows], "right") - 1
                sequence[rows], offset[rows] = seq[i] + rank[rows] - first[i], off[i]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    shape = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long")).mapInArrow(place, shape)
