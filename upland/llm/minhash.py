"""Near-duplicate groups by HyperMinHash.

1. Every document gets the set of its distinct 5-word shingles (64-bit hashes), a digest of the set
   and a HyperMinHash sketch: shingles fall into buckets by hash, and a bucket keeps its least
   value as a register of 6 bits for the count of leading zeros and 10 bits of mantissa. Empty
   buckets borrow from others in a fixed pseudo-random order, so short documents band as well.
2. Documents with equal sets are one class, led by the least doc_id; only leaders go on.
3. Bands of registers are hashed. Leaders that share a band are candidates. Each is held against the band's
   pivot, its least leader, on the full sets; a pivot's members are dealt out, so a pivot that a third of
   all documents share is no single task. Links make classes (components).
4. A band whose members are of one class, or that has two members, is done. In the others, members that
   aren't of the pivot's class may still be linked to others than the pivot. Jaccard distance is a metric, so a
   member closer to the pivot than the nearest of these, less the distance that links, can't be: it is left out. For
   ROUNDS rounds, should a band keep more than CROWD members, those left are held against another pivot of their band, taken
   by hash, if it is of another class, which joins most of them to the pivot's class. What remains goes to tasks by band (bands with the same members once). There, rows of links are worked out only for
   members outside the largest class: a row is filtered by size and by the Jaccard estimate, corrected
   for chance collisions of registers, with a margin of six standard deviations, and compared on the full sets.
   Should the sets of a band exceed GROUP_SHINGLES even so, its members are dealt to tasks of two blocks each.
5. All links give the components. Copies of a set and pairs of a band are never expanded into all pairs.

With t the threshold, a linked pair shares no band with probability at most 1e-7.

Defined cases: null or empty texts, and texts of white space, have an empty set, are linked with
nothing and keep themselves; a text of fewer than five words is one shingle; rows without doc_id are
left out; rows that share a doc_id are parts of one document, which is linked if one of them is; an
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MIX, column, components, gram_hashes, hashes, join_counted, materialize, mix, plain, small_batches

SHINGLE, MANTISSA = 5, 10
#: Shingles that the two blocks of one task hold at most, but for single documents beyond it.
GROUP_SHINGLES = 4_000_000
MISS = 1e-7
#: Members of a pivot that one task holds against it, about.
DEALT = 2_000
#: Further pivots of the bands that one pivot doesn't settle.
ROUNDS = 2
#: Members of a band that go to a task without further pivots.
CROWD = 500


def banding(percent: int) -> tuple[int, int]:
    """Registers in a band and bands, for a threshold in percent."""
    t = percent / 100
    rows = 7 if percent >= 85 else 6
    return rows, math.ceil(math.log(MISS) / math.log(1 - t**rows))


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted distinct shingles of a text; bytes.lower() touches A-Z only."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(hashes(words), min(SHINGLE, len(words))))


def registers(sets: list[np.ndarray], k: int) -> np.ndarray:
    """A row of k registers (uint16) for each set; a row of an empty set is zero."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    least = np.full((len(sets), k), np.iinfo(np.uint64).max)
    every = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    bucket = ((every >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    np.minimum.at(least.reshape(-1), np.repeat(np.arange(len(sets)) * k, sizes) + bucket.astype(np.int64), mix(every ^ MIX))
    full = least != np.iinfo(np.uint64).max
    part, power = np.frexp(least.astype(np.float64))
    regs = ((64 - np.minimum(power, 64)).astype(np.uint16) << MANTISSA) | ((part * 2 - 1) * (1 << MANTISSA)).astype(np.uint16)
    at = np.arange(k, dtype=np.uint64)
    open_rows = np.flatnonzero((sizes > 0) & ~full.all(axis=1))
    done, turn = full.copy(), 0
    while len(open_rows):
        turn += 1
        # after k turns, buckets are taken in order of distance, which always ends
        source = (mix(at * MIX + np.uint64(turn)) % np.uint64(k)).astype(np.int64) if turn <= k else (np.arange(k) + turn) % k
        got = ~done[open_rows] & full[open_rows][:, source]
        r, c = np.nonzero(got)
        regs[open_rows[r], c] = regs[open_rows[r], source[c]]
        done[open_rows[r], c] = True
        open_rows = open_rows[~done[open_rows].all(axis=1)]
    regs[sizes == 0] = 0
    return regs


def band_keys(regs: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """Keys (int64) of each row's bands; the band's number is part of the key."""
    at = regs[:, : rows * bands].reshape(len(regs), bands, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * MIX), (len(regs), bands)).copy()
        for i in range(rows):
            key = mix(key * MIX + at[:, :, i] + np.uint64(1))
    return key.view(np.int64)


def _collisions(n: np.ndarray, m: int, k: int) -> np.ndarray:
    """Chance that registers of unrelated sets of n and m shingles agree."""
    i = np.arange(64)[:, None]

    def zeros(size: np.ndarray) -> np.ndarray:
        load = np.maximum(size / k, 1e-9)
        return np.exp(-load * 2.0 ** -(i + 1.0)) - np.exp(-load * 2.0**-i)

    return (zeros(n) * zeros(np.array([m]))).sum(axis=0) / (1 << MANTISSA)


def linked_members(ids: np.ndarray, sets: list[np.ndarray], regs: np.ndarray, percent: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(member, class's least member) for each class of at least two, within one candidate group; members with the same
    number in known are of one class beforehand."""
    n, k = len(ids), regs.shape[1]
    sizes = np.fromiter(map(len, sets), np.int64, n)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(names), bool)
    label, spent = np.arange(n) if known is None else np.unique(known, return_inverse=True)[1], np.zeros(n, bool)
    t = percent / 100
    while True:
        count = np.bincount(label, minlength=n)
        if known is not None and count.max() == n:
            break
        todo = np.flatnonzero((label != count.argmax()) & ~spent)
        if not len(todo):
            break
        x = todo[0]
        spent[x] = True
        near = (label != label[x]) & (np.minimum(sizes, sizes[x]) * 100 >= percent * np.maximum(sizes, sizes[x]))
        c = np.flatnonzero(near)
        if len(c):
            agree = (regs[c] == regs[x]).mean(axis=1)
            chance = _collisions(sizes[c], sizes[x], k)
            estimate = (agree - chance) / (1 - chance)
            margin = 6 * np.sqrt(t * (1 - t) / np.minimum(np.minimum(sizes[c], sizes[x]), k))
            c = c[estimate >= t - margin]
        if not len(c):
            continue
        mark[flat[starts[x] : starts[x] + sizes[x]]] = True
        lengths = sizes[c]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(starts[c] - (ends - lengths), lengths)
        both = np.add.reduceat(mark[flat[at]].astype(np.int64), ends - lengths)
        mark[flat[starts[x] : starts[x] + sizes[x]]] = False
        joined = np.unique(np.append(label[c[both * 100 >= percent * (sizes[x] + lengths - both)]], label[x]))
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    count = np.bincount(label, minlength=n)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    return [(int(ids[i]), int(least[label[i]])) for i in np.flatnonzero(count[label] > 1) if ids[i] != least[label[i]]]


def _set_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set of the rows of docs that wanted (doc_id, want: digest of the set) names."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(x) for x in column(b, "text")]
            same = [xxhash.xxh3_128_digest(s.tobytes()) == w for s, w in zip(sets, column(b, "want"), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "n_shingles", "set"]).filter(pa.array(same, pa.bool_()))

    # shuffled at any size: how many texts have near-copies isn't known
    found = plain(docs).hint("merge").join(wanted, "doc_id").select("doc_id", "text", "want")
    return materialize(found.mapInArrow(work, "doc_id long, n_shingles long, set binary"))


def _against_pivots(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) with linked and far, their Jaccard distance (null where a document has several sets)."""
    parts = materialize(pairs.groupBy("b").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / DEALT).cast("int")))
    pivots = parts.join(sets.withColumnRenamed("doc_id", "b"), "b").select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("a"), "set")
    counted = join_counted(pairs, parts, ["b"])
    members = counted.select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")).join(sets.withColumnRenamed("doc_id", "a"), "a").select("b", "part", "a", "set")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            rows = []
            for b, part, a, data in zip(*(column(batch, x) for x in ("b", "part", "a", "set")), strict=True):
                now = np.frombuffer(data, np.uint64)
                if (b, part) != key:
                    key, held = (b, part), []
                if a is None:  # pivots come first
                    held.append(now)
                    continue
                for pivot in held:
                    both = len(np.intersect1d(now, pivot, assume_unique=True))
                    union = len(now) + len(pivot) - both
                    rows.append((a, b, 100 * both >= percent * union, 1 - both / union))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.bool_(), pa.float64()), strict=True)], ["a", "b", "linked", "far"])

    dealt = pivots.unionByName(members).repartition("b", "part").sortWithinPartitions("b", "part", "a")
    found = dealt.mapInArrow(work, "a long, b long, linked boolean, far double").groupBy("a", "b")
    return materialize(found.agg(F.max("linked").alias("linked"), F.when(F.count("*") == 1, F.min("far")).alias("far")))


def _unsettled(members: DataFrame, checked: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """key, doc_id, label of the members (key, a, b: its pivot) of bands that may still hold a link between classes."""
    own = members.join(labels.withColumnRenamed("node", "a"), "a", "left").withColumn("label", F.coalesce("label", "a"))
    own = materialize(own.join(checked.select("a", "b", "far"), ["a", "b"], "left").select("key", "a", "label", (F.col("a") == F.col("b")).alias("is_pivot"), "far"))
    classes = own.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.max(F.when(F.col("is_pivot"), F.col("label"))).alias("main")).where("n > 2 AND lo < hi").select("key", "n", "main")
    several = materialize(join_counted(own, materialize(classes), ["key"]).where("NOT is_pivot").select("key", "a", "label", "main", "far"))
    # none of the others is nearer to the pivot than this
    nearest = several.groupBy("key").agg(F.count("*").alias("n"), F.min(F.when(F.col("label") != F.col("main"), F.coalesce("far", F.lit(0.0)))).alias("nearest"))
    reach = F.col("nearest") - (100 - percent) / 100 - 1e-9
    left = join_counted(several, materialize(nearest), ["key"]).where(F.col("far").isNull() | (F.col("far") >= reach)).select("key", "a", "label")
    left = materialize(left)
    # bands with the same members are one; a digest of 128 bits stands for the members
    sums = [F.sum(F.xxhash64("a", F.lit(k)).cast("decimal(20,0)")).alias(f"s{k}") for k in (1, 2)]
    lists = left.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), *sums).where("lo < hi")
    chosen = lists.groupBy("n", "s1", "s2").agg(F.min("key").alias("key")).select("key", "n")
    return join_counted(left, materialize(chosen), ["key"]).select("key", F.col("a").alias("doc_id"), "label")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, n_copies (documents with the same set) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    rows, bands = banding(percent)
    docs = docs.where("doc_id IS NOT NULL")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(x) for x in column(b, "text")]
            keys = band_keys(registers(sets, rows * bands), rows, bands)
            digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            offsets = pa.array(np.arange(len(sets) + 1) * bands, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))], ["doc_id", "n_shingles", "digest", "bands"])

    base = materialize(plain(docs).mapInArrow(sketch, "doc_id long, n_shingles long, digest binary, bands array<long>"))
    full = base.where("digest IS NOT NULL")
    leaders = materialize(full.groupBy("digest").agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")))
    led = join_counted(full, leaders, ["digest"]).where("doc_id = leader").select("doc_id", "digest", "bands")
    spread = materialize(led.select(F.col("doc_id").alias("a"), "digest", F.explode("bands").alias("key")))
    pivots = spread.groupBy("key").agg(F.count("*").alias("n"), F.min("a").alias("b"), F.max("a").alias("z")).where("b < z").select("key", "n", "b")
    members = materialize(join_counted(spread, materialize(pivots), ["key"]).select("key", "a", "digest", "b").distinct())
    sets = _set_rows(docs, members.select(F.col("a").alias("doc_id"), F.col("digest").alias("want")).distinct())
    members = members.select("key", "a", "b").distinct()
    checked = _against_pivots(members.where("a <> b").select("a", "b").distinct(), sets, percent)
    near = checked.where("linked").select("a", "b")
    labels = components(near)
    left = materialize(_unsettled(members, checked, labels, percent))
    for k in range(ROUNDS):
        if (left.groupBy("key").count().agg(F.max("count")).first()[0] or 0) <= CROWD:
            break
        chosen = left.groupBy("key").agg(F.count("*").alias("n"), F.min_by(F.struct(F.col("doc_id").alias("b"), F.col("label").alias("class")), F.xxhash64("doc_id", F.lit(k))).alias("p"))
        pairs = join_counted(left, materialize(chosen.select("key", "n", "p.b", "p.class")), ["key"]).where("label <> class").select(F.col("doc_id").alias("a"), "b").distinct()
        pairs = materialize(pairs)
        if pairs.isEmpty():
            break
        near = materialize(near.union(_against_pivots(pairs, sets, percent).where("linked").select("a", "b")))
        labels = components(near)
        left = materialize(_unsettled(members, checked, labels, percent))

    # what is left, by band
    member = left.join(sets.select("doc_id", "n_shingles"), "doc_id")
    size = member.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"), F.ceil(F.sum("n_shingles") * 2 / GROUP_SHINGLES).alias("half"))
    blocks = F.when(F.col("total") <= GROUP_SHINGLES, F.lit(1)).otherwise(F.greatest(F.col("half"), F.lit(2))).cast("int")
    placed = join_counted(left, materialize(size.select("key", "n", blocks.alias("n_blocks"))), ["key"]).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")).cast("int"))
    others = F.when(F.col("n_blocks") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda o: o != F.col("own")))
    dealt = placed.select("key", "doc_id", "label", "own", F.explode(others).alias("other")).select("key", "doc_id", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    dealt = dealt.join(sets.select("doc_id", "set"), "doc_id")

    def link(group: pa.Table) -> pa.Table:
        ids = group.column("doc_id").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("set").to_pylist()]
        found = linked_members(ids, sets, registers(sets, rows * bands), percent, group.column("label").to_numpy())
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    more = dealt.groupBy("key", "i", "j").applyInArrow(link, "a long, b long")
    more = materialize(more.distinct())
    if not more.isEmpty():
        labels = components(near.union(more))
    classes = leaders.join(labels, leaders.leader == labels.node, "left").select("digest", "n", F.coalesce("label", "leader").alias("component"))
    named = join_counted(full.select("doc_id", "n_shingles", "digest"), materialize(classes), ["digest"]).select("doc_id", "n_shingles", "component", F.col("n").alias("n_copies"))
    # documents without shingles are linked with nothing
    alone = base.where("digest IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component"), F.lit(None).cast("long").alias("n_copies"))
    return named.unionByName(alone).select("doc_id", "n_shingles", F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"), "n_copies")


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs, unchanged, one for each component of near-duplicates; those without doc_id stay.

    Rows that share a doc_id are copies if their texts are equal and else documents of their own: the text with the
    least hash goes by its doc_id, each other by a number of 2^62 or more, so that a component keeps its least doc_id."""
    known = docs.where("doc_id IS NOT NULL").select(F.struct("*").alias("row"))
    tag = F.xxhash64("row.text")
    shared = known.groupBy(F.col("row.doc_id").alias("shared")).agg(F.min(tag).alias("first"), F.max(tag).alias("last")).where("first <> last")
    shared = materialize(shared.select("shared", "first"))
    if shared.isEmpty():
        known = known.withColumn("node", F.col("row.doc_id"))
    else:
        own = F.xxhash64("row.doc_id", "row.text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        node = F.when(F.col("first") != tag, own).otherwise(F.col("row.doc_id"))
        known = materialize(known.hint("merge").join(shared, F.col("row.doc_id") == F.col("shared"), "left").select("row", node.alias("node")))
    gone = near_duplicates(known.select(F.col("node").alias("doc_id"), F.col("row.text").alias("text")), percent).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    known = known.hint("merge").join(gone, F.col("node") == F.col("gone"), "left_anti")
    known = known.withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("row.text")))).where("nth = 1").select("row.*")
    return known.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
