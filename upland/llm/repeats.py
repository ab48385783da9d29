"""What the two substring operators share: candidate contexts, their partition, and the way back to spans.

A window is WINDOW consecutive words of one document. It is repeated, for a document, if its words also
start in a document with a smaller doc_id. The work is split by content:

1. A window's anchor is its least-hashed run of GRAM words (a minimiser): equal windows have equal
   anchors at the same place. Anchors that lie in one document only are dropped; about every twentieth
   word is an anchor.
2. Windows with the same anchor place form one context: the words from the first window's start to the
   last one's end. Equal contexts are one row with the least and the greatest doc_id, summed before
   they are shuffled, so a passage that a third of all documents share is one row.
3. The words of each context are read from one document that has it and go to tasks by anchor. An anchor
   with more than GROUP different contexts doesn't go as a whole: its windows are dealt by their own first
   words instead, by prefixes that grow through PREFIXES until a group has GROUP windows at most. A
   prefix that lies in one document only is dropped, and one of WINDOW words is a repeat as it is.
4. In each group a finder (suffix array or suffix tree) gives every window the least doc_id among
   equal windows. Runs of windows go back to the occurrences of their context and become spans of words.

Finders compare the words themselves. Equal contexts and long prefixes are known by 128-bit digests of
their words. Joins by anchor or context deal out keys that many rows have (join_counted).

Defined cases: null and empty texts and texts of fewer than WINDOW words have no spans; repeats within
one document and between rows that share a doc_id don't count; rows without doc_id are left alone; very
long texts are read whole, a batch of few rows at a time; equal windows of several documents go by the
least doc_id; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, hashes, join_counted, materialize, mix, plain, small_batches

WINDOW, GRAM = 50, 12
SPAN = WINDOW - GRAM + 1
#: Contexts or windows of a group at most; contexts that a finder gets at once, about. A group costs its finder n log n, so
#: only one that a task couldn't take at once is worth a row for each of its windows.
GROUP, CHUNK = 4_000, 5_000
#: Words of the prefixes that deal out the windows of anchors with too many contexts.
PREFIXES = (20, 35, WINDOW)
PLACE = np.uint64(26)
STEP = np.uint64(0x9E3779B97F4A7C15)


class Contexts:
    """Contexts, in the order of their groups; words are numbered, equal numbers for equal words, in one array with a start for each."""

    def __init__(self, group: np.ndarray, lead: np.ndarray, words: list[bytes], low: np.ndarray):
        self.group, self.lead, self.low = group, lead, low
        split = [x.split(b" ") for x in words]
        self.size = np.fromiter(map(len, split), np.int64, len(split))
        self.start = np.cumsum(self.size) - self.size
        number: dict[bytes, int] = {}
        self.words = np.fromiter((number.setdefault(w, len(number)) for x in split for w in x), np.int64, int(self.size.sum()))
        self.windows = self.size - WINDOW + 1


#: From contexts to the least doc_id of each window, laid end to end.
Finder = Callable[[Contexts], np.ndarray]


def grams(words: np.ndarray) -> np.ndarray:
    """Hash of every GRAM consecutive words."""
    n = len(words) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        two = words[:-1] * STEP + words[1:]
        four = two[:-2] * (STEP * STEP) + two[2:]
        eight = four[:-4] * (STEP * STEP * STEP * STEP) + four[4:]
        return mix(eight[:n] * (STEP * STEP * STEP * STEP) + four[8 : 8 + n])


def anchors(gram: np.ndarray) -> np.ndarray:
    """The place of each window's anchor, in the order of windows."""
    n = len(gram) - SPAN + 1
    if n <= 0:
        return np.empty(0, np.int64)
    step = (1 << int(PLACE)) - SPAN
    out = []
    for base in range(0, n, step):  # places within a part fit their bits
        part = gram[base : base + step + SPAN - 1]
        key = ((part >> PLACE) << PLACE) | np.arange(len(part), dtype=np.uint64)
        least, width = key, 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SPAN - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        out.append((least & np.uint64((1 << int(PLACE)) - 1)).astype(np.int64) + base)
    return np.concatenate(out)


def tagged(docs: DataFrame, *names: str) -> DataFrame:
    """doc_id, text as bytes, tag: rows that share a doc_id are told apart by their texts."""
    return plain(docs, *names).withColumn("tag", F.xxhash64("text"))


def _spread_anchors(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for text in column(b, "text"):
                gram = grams(hashes((text or b"").split()))
                found.append(np.unique(gram[np.unique(anchors(gram))]).view(np.int64))
            offsets = np.cumsum([0] + [len(x) for x in found])
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))], ["doc_id", "anchors"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, anchors array<long>")


def occurrences(docs: DataFrame) -> DataFrame:
    """anchor, digest, lead, windows, doc_id, tag, at: the contexts of anchors that several documents have."""
    spread = materialize(_spread_anchors(docs))
    each = spread.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor", "n")
    wanted = join_counted(each, materialize(shared), ["anchor"]).groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for doc, tag, text, keep in zip(*(column(b, x) for x in ("doc_id", "tag", "text", "anchors")), strict=True):
                words = (text or b"").split()
                gram = grams(hashes(words))
                place = anchors(gram)
                if not len(place):
                    continue
                first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                last = np.append(first[1:], len(place)) - 1
                at = place[first]
                own = gram[at].view(np.int64)
                for i in np.flatnonzero(np.isin(own, np.array(keep, np.int64))).tolist():
                    lead = int(at[i] - first[i])
                    digest = xxhash.xxh3_128_digest(b" ".join(words[first[i] : last[i] + WINDOW]), lead)
                    rows.append((int(own[i]), digest, lead, int(last[i] - first[i] + 1), doc, tag, int(first[i])))
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["anchor", "digest", "lead", "windows", "doc_id", "tag", "at"])

    # shuffled at any size: how many texts hold repeats isn't known
    found = docs.hint("merge").join(wanted, "doc_id").select("doc_id", "tag", "text", "anchors")
    return materialize(found.mapInArrow(work, "anchor long, digest binary, lead int, windows int, doc_id long, tag long, at int"))


#: A context or window whose words are wanted: it has `windows` windows, starting with window w of its context, in n occurrences.
ASKED = ("group", "anchor", "digest", "w", "lead", "low", "high", "n", "at", "windows")


def _read(docs: DataFrame, asked: DataFrame, rows_of: Callable[[list[bytes], dict], list[tuple]], shape: dict[str, pa.DataType]) -> DataFrame:
    """rows_of(words of the document, row asked for) of all rows of asked (ASKED, doc_id, tag), as a table."""
    wanted = asked.groupBy("doc_id", "tag").agg(F.collect_list(F.struct(*ASKED)).alias("asked"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for doc, tag, text, asked in zip(*(column(b, x) for x in ("doc_id", "tag", "text", "asked")), strict=True):
                words = (text or b"").split()
                for x in asked:
                    rows += rows_of(words, x | {"doc_id": doc, "tag": tag})
            cols = list(zip(*rows, strict=True)) or [[]] * len(shape)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, shape.values(), strict=True)], list(shape))

    # one row of a text is enough, should there be several
    texts = docs.hint("merge").join(wanted, ["doc_id", "tag"]).select("doc_id", "tag", "text", "asked").dropDuplicates(["doc_id", "tag"])
    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return materialize(texts.mapInArrow(work, ", ".join(f"{x} {names[t]}" for x, t in shape.items())))


_LONG, _INT, _BYTES = pa.int64(), pa.int32(), pa.binary()
_WORDED = {"group": _LONG, "anchor": _LONG, "digest": _BYTES, "w": _INT, "lead": _INT, "low": _LONG, "high": _LONG, "n": _LONG, "words": _BYTES}
_PREFIXED = {"anchor": _LONG, "digest": _BYTES, "low": _LONG, "high": _LONG, "n": _LONG, "doc_id": _LONG, "tag": _LONG, "w": _INT, "at": _INT} | {f"p{i}": _BYTES for i in range(len(PREFIXES))}


def _worded(words: list[bytes], x: dict) -> list[tuple]:
    return [(*(x[k] for k in ASKED[:8]), b" ".join(words[x["at"] : x["at"] + x["windows"] + WINDOW - 1]))]


def _prefixed(words: list[bytes], x: dict) -> list[tuple]:
    """The windows of a context, with the digests of their prefixes."""
    own = tuple(x[k] for k in ("anchor", "digest", "low", "high", "n", "doc_id", "tag"))
    at = range(x["at"], x["at"] + x["windows"])
    return [(*own, w, i, *(xxhash.xxh3_128_digest(b" ".join(words[i : i + p])) for p in PREFIXES)) for w, i in enumerate(at)]


def dealt(docs: DataFrame, kinds: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """What finders get (ASKED, doc_id, tag), in groups of at most GROUP rows, and the runs (anchor, digest, n, w0, w1, least)
    that are known by the longest prefix; kinds: anchor, digest, lead, windows, low, high, n, doc_id, tag, at."""
    several = kinds.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
    several = materialize(several)
    whole = kinds.withColumn("group", F.col("anchor")).withColumn("w", F.lit(0))
    if several.isEmpty():
        return whole.select(*ASKED, "doc_id", "tag"), []
    marked = join_counted(whole.withColumnRenamed("n", "times"), several.withColumn("crowded", F.lit(True)), ["anchor"], "left").drop("n").withColumnRenamed("times", "n")
    marked = materialize(marked)
    parts = [marked.where("crowded IS NULL").select(*ASKED, "doc_id", "tag")]
    rest = _read(docs, marked.where("crowded").select(*ASKED, "doc_id", "tag"), _prefixed, _PREFIXED)
    known: list[DataFrame] = []
    for i, length in enumerate(PREFIXES):
        p = f"p{i}"
        groups = rest.groupBy(p).agg(F.count("*").alias("n"), F.min("low").alias("least"), F.max("high").alias("most")).where("least < most")
        joined = join_counted(rest.withColumnRenamed("n", "times"), materialize(groups), [p]).withColumnRenamed("n", "size").withColumnRenamed("times", "n")
        if length == WINDOW:
            known.append(joined.where("least < high").select("anchor", "digest", "n", F.col("w").alias("w0"), F.col("w").alias("w1"), "least"))
            break
        joined = materialize(joined)
        own = joined.where(F.col("size") <= GROUP).withColumn("group", F.xxhash64(p)).withColumn("lead", F.lit(0)).withColumn("windows", F.lit(1))
        parts.append(own.select(*ASKED, "doc_id", "tag"))
        rest = joined.where(F.col("size") > GROUP).select(*rest.columns)
    return reduce(DataFrame.unionByName, parts), known


def _runs(c: Contexts, high: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context, first and last window and least doc_id of each run of windows that someone has to drop."""
    owner = np.repeat(np.arange(len(c.size)), c.windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(c.windows) - c.windows, c.windows)
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (least[1:] != least[:-1]))) if len(owner) else np.empty(0, np.int64)
    last = np.append(first[1:], len(owner)) - 1 if len(owner) else first
    keep = least[first] < high[owner[first]]
    first, last = first[keep], last[keep]
    return owner[first], place[first], place[last], least[first]


def _answer(rows: pa.Table, find: Finder) -> pa.RecordBatch:
    """Runs of the windows of whole groups."""
    rows = rows.sort_by("group")
    get = lambda name: rows.column(name).to_numpy()
    c = Contexts(get("group"), get("lead").astype(np.int64), rows.column("words").to_pylist(), get("low"))
    owner, w0, w1, least = _runs(c, get("high"), find(c))
    digest = rows.column("digest").combine_chunks().take(pa.array(owner))
    base = get("w")[owner]
    cols = [pa.array(get("anchor")[owner]), digest, pa.array(get("n")[owner]), pa.array((base + w0).astype(np.int32)), pa.array((base + w1).astype(np.int32)), pa.array(least)]
    return pa.RecordBatch.from_arrays(cols, ["anchor", "digest", "n", "w0", "w1", "least"])


def repeated_spans(docs: DataFrame, find: Finder) -> DataFrame:
    """doc_id, tag (of the text), start, stop (words), first_doc: spans of repeated windows; those of one document may overlap."""
    small_batches(docs.sparkSession)
    docs = tagged(docs).where("doc_id IS NOT NULL")
    found = occurrences(docs)
    kinds = found.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min(F.struct("doc_id", "tag", "at")).alias("in"), F.min("lead").alias("lead"), F.min("windows").alias("windows")
    )
    kinds = materialize(kinds.select("anchor", "digest", "n", "low", "high", "lead", "windows", "in.doc_id", "in.tag", "in.at"))
    asked, known = dealt(docs, kinds)
    worded = _read(docs, asked, _worded, _WORDED)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            n += b.num_rows
            if n >= CHUNK:
                rows = pa.Table.from_batches(held)
                groups = rows.column("group").to_numpy()
                cut = int(np.searchsorted(groups, groups[-1], "left"))  # the last group may go on
                if cut:
                    yield _answer(rows.slice(0, cut), find)
                    held, n = rows.slice(cut).to_batches(), len(rows) - cut
        if held:
            yield _answer(pa.Table.from_batches(held), find)

    runs = worded.repartition("group").sortWithinPartitions("group").mapInArrow(gather, "anchor long, digest binary, n long, w0 int, w1 int, least long")
    runs = reduce(DataFrame.unionByName, known, runs)
    of_context = runs.groupBy("anchor", "digest").agg(F.first("n").alias("n"), F.collect_list(F.struct("w0", "w1", "least")).alias("runs"))
    back = join_counted(found.select("anchor", "digest", "doc_id", "tag", "at"), materialize(of_context), ["anchor", "digest"])
    back = back.select("doc_id", "tag", "at", F.explode("runs").alias("run")).where("run.least < doc_id")
    return materialize(back.select("doc_id", "tag", (F.col("at") + F.col("run.w0")).alias("start"), (F.col("at") + F.col("run.w1") + WINDOW).alias("stop"), F.col("run.least").alias("first_doc")))


def covered(n: int, spans: list) -> np.ndarray:
    """Which of n words lie in a span."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans:
        edge[s["start"]] += 1
        edge[s["stop"]] -= 1
    return np.cumsum(edge[:-1]) > 0


def with_spans(docs: DataFrame, spans: DataFrame, *names: str) -> DataFrame:
    """doc_id, text (bytes), names and the spans of every document, null for none."""
    each = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "stop", "first_doc")).alias("spans"))
    return tagged(docs, *names).hint("merge").join(each, ["doc_id", "tag"], "left")
