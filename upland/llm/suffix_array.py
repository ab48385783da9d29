"""Sparse suffix arrays: repeated passages of at least 50 words.

Only the suffixes that start at anchors (minimiser positions, see repeats.py) are kept. Each group of them
is sorted by the words from the anchor on, and neighbours are compared: lcp is the number of words that a
suffix shares with the one before. The same is done with the words before the anchors, read backwards, so
a match extends to the left. Suffixes whose neighbours all share enough words are one class; a window
that begins d words before its anchor is equal in two places just if they are of one class for 50 - d
words to the right and of one class for d words to the left. No pairs are formed. Where an anchor has too
many surroundings for a group, the suffixes kept are those of its windows' starts, grouped by longer prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column
from .repeats import SPAN, WINDOW, Contexts, covered, repeated_spans, with_spans


def _sorted_lcp(c: Contexts, width: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by `width` words from the anchor on (step 1) or before it backwards (step -1),
    within each group, and each one's lcp with the one before it in that order."""
    anchor_at = c.start + c.lead
    have = c.size - c.lead if step > 0 else c.lead
    at = anchor_at[:, None] + (np.arange(width) if step > 0 else -1 - np.arange(width))
    beyond = np.arange(width) >= have[:, None]
    words = c.words[np.clip(at, 0, max(len(c.words) - 1, 0))]
    # behind its end, a suffix equals no other: each has a number of its own there
    words[beyond] = -1 - np.broadcast_to(np.arange(len(have))[:, None], words.shape)[beyond]
    order = np.lexsort([*words.T[::-1], c.group])
    rows = words[order]
    same = rows[1:] == rows[:-1]
    lcp = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
    lcp[c.group[order][1:] != c.group[order][:-1]] = -1
    return order, np.append(-1, lcp) if len(order) else lcp


def find(c: Contexts) -> np.ndarray:
    right, right_lcp = _sorted_lcp(c, WINDOW, 1)
    left, left_lcp = _sorted_lcp(c, SPAN - 1, -1)
    base = np.cumsum(c.windows) - c.windows
    out = np.empty(int(c.windows.sum()), np.int64)
    n = len(c.size)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(SPAN):
        w = c.lead - d
        rows = np.flatnonzero((w >= 0) & (w < c.windows))
        if not len(rows):
            continue
        right_class[right] = np.cumsum(right_lcp < WINDOW - d)
        left_class[left] = np.cumsum(left_lcp < d)
        both = right_class[rows] * (n + 1) + left_class[rows]
        order = np.argsort(both, kind="stable")
        first = np.flatnonzero(np.append(True, both[order][1:] != both[order][:-1]))
        least = np.minimum.reduceat(c.low[rows[order]], first)
        out[base[rows[order]] + w[rows[order]]] = np.repeat(least, np.diff(np.append(first, len(rows))))
    return out


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, stop_word, n_words, first_doc_id: every maximal run of words that lie in windows
    of 50 words which also start in a document with a smaller doc_id; first_doc_id is the least of those.
    Nulls, short, repeated and long texts, ties and further columns: see repeats.py."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, spans in zip(column(b, "doc_id"), column(b, "spans"), strict=True):
                held: list[int] = []
                for s in sorted(spans, key=lambda s: s["start"]):
                    if held and s["start"] <= held[1]:
                        held = [held[0], max(held[1], s["stop"]), min(held[2], s["first_doc"])]
                        continue
                    if held:
                        rows.append((doc, *held))
                    held = [s["start"], s["stop"], s["first_doc"]]
                rows.append((doc, *held))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], ["doc_id", "start_word", "stop_word", "first_doc_id"])

    spans = repeated_spans(docs, find).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "stop", "first_doc")).alias("spans"))
    found = spans.select("doc_id", "spans").mapInArrow(merge, "doc_id long, start_word long, stop_word long, first_doc_id long")
    return found.select("doc_id", "start_word", "stop_word", (F.col("stop_word") - F.col("start_word")).alias("n_words"), "first_doc_id")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated passages: words are cut out with the white space before them,
    the rest stays as it was; n_chars follows. A document that has nothing left goes; those without a
    repeated passage stay unchanged."""
    names = docs.columns
    spans = repeated_spans(docs, find)
    # the other columns go along as one, so their names clash with nothing
    rest = docs.select("doc_id", "text", F.struct(*[x for x in names if x not in ("doc_id", "text")] or [F.lit(0).alias("none")]).alias("rest"))
    shape = with_spans(rest, spans, "rest").select("doc_id", "text", "rest").schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(rb"[^\x20\x09-\x0d]+")
        for b in batches:
            texts, keep = column(b, "text"), []
            for i, spans in enumerate(column(b, "spans")):
                if not spans:
                    keep.append(True)
                    continue
                text = texts[i]
                ends = [m.end() for m in word.finditer(text)]
                gone = covered(len(ends), spans)
                parts, at = [], 0
                for end, dropped in zip(ends, gone.tolist(), strict=True):
                    if not dropped:
                        parts.append(text[at:end])
                    at = end
                texts[i] = b"".join(parts) + text[at:] if parts else b""
                if gone[0]:
                    texts[i] = texts[i].lstrip(b" \t\n\r\x0b\x0c")
                keep.append(bool(parts))
            out = [pa.array(texts, pa.binary()) if f.name == "text" else c for f, c in zip(b.schema, b.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(out, names=b.schema.names).drop_columns(["spans"]).filter(pa.array(keep, pa.bool_()))

    done = with_spans(rest, spans, "rest").select("doc_id", "text", "rest", "spans").mapInArrow(cut, shape).withColumn("text", F.col("text").cast("string"))
    place = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*[place.get(x, F.col("rest").getField(x)).alias(x) for x in names])
