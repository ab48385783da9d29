"""Prefix-partitioned suffix trees: every word in a repeated window of 50 words.

The suffixes are the starts of all windows whose anchor several documents have. Their groups are of
bounded size (see repeats.py): all suffixes whose prefix ends with the same anchor, 12 to 50 words, are one
group; where that is too large, it is split by prefixes that grow to 20, 35 and 50 words until each fits.

A group gets its subtree, built top down: a node is a set of suffixes that begin with the same words. While
all go on with the same word, the edge to the node grows; else the node is divided into its children, one
for each next word. Nodes with suffixes of a single document are leaves. A node that reaches 50 words is a
deep internal node: a repeat, with the least document that has it. Runs of windows that are neighbours and
repeats are the maximal ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column
from .repeats import WINDOW, Contexts, covered, repeated_spans, with_spans


@dataclass
class Subtree:
    """Nodes of the subtrees of several groups, parents before children; the suffixes lie in order[first : last] of each."""

    order: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    first: np.ndarray
    last: np.ndarray
    least: np.ndarray


def _bounds(key: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)


def build(words: np.ndarray, at: np.ndarray, root: np.ndarray, doc: np.ndarray, deepest: int = WINDOW) -> Subtree:
    """The internal nodes over the suffixes words[at ..], a subtree for each root; root and doc belong to the suffixes."""
    order = np.argsort(root, kind="stable")
    starts = _bounds(root[order])
    live_first, live_last = starts, np.append(starts[1:], len(order))
    live_parent, live_depth = np.full(len(starts), -1), np.zeros(len(starts), np.int64)
    kept: list[tuple[np.ndarray, ...]] = []
    made = 0
    while len(live_first):
        # leaves: nothing but one document
        size = live_last - live_first
        inside = np.repeat(live_first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        cut = np.cumsum(size) - size
        of = doc[order[inside]]
        least, most = np.minimum.reduceat(of, cut), np.maximum.reduceat(of, cut)
        stay = least < most
        live_first, live_last, live_parent, live_depth, least = (x[stay] for x in (live_first, live_last, live_parent, live_depth, least))
        # edges grow while all suffixes of a node go on alike
        growing = np.flatnonzero(live_depth < deepest)
        while len(growing):
            size = live_last[growing] - live_first[growing]
            cut = np.cumsum(size) - size
            inside = np.repeat(live_first[growing] - cut, size) + np.arange(size.sum())
            word = words[at[order[inside]] + np.repeat(live_depth[growing], size)]
            alike = np.minimum.reduceat(word, cut) == np.maximum.reduceat(word, cut)
            growing = growing[alike]
            live_depth[growing] += 1
            growing = growing[live_depth[growing] < deepest]
        number = made + np.arange(len(live_first))
        kept.append((live_parent, live_depth, live_first, live_last, least))
        made += len(live_first)
        # children: the suffixes of a node by their next word
        inner = np.flatnonzero(live_depth < deepest)
        size = live_last[inner] - live_first[inner]
        inside = np.repeat(live_first[inner] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        node = np.repeat(np.arange(len(inner)), size)
        word = words[at[order[inside]] + np.repeat(live_depth[inner], size)]
        by = np.lexsort((word, node))
        order[inside] = order[inside][by]
        word, node = word[by], node[by]
        child = _bounds(node * (int(words.max()) + 1 if len(words) else 1) + word)
        live_parent, live_depth = number[inner][node[child]], live_depth[inner][node[child]] + 1
        live_first = inside[child]
        live_last = live_first + np.diff(np.append(child, len(node)))
    cols = [np.concatenate(x) for x in zip(*kept, strict=True)] if kept else [np.empty(0, np.int64)] * 5
    return Subtree(order, *cols)


def find(c: Contexts) -> np.ndarray:
    owner = np.repeat(np.arange(len(c.size)), c.windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(c.windows) - c.windows, c.windows)
    low = c.low[owner]
    least = low.copy()
    if not len(owner):
        return least
    # a root for each length of the prefix that ends with the anchor
    before = c.lead[owner] - place
    group = np.cumsum(np.append(False, c.group[1:] != c.group[:-1]))[owner]
    tree = build(c.words, c.start[owner] + place, group * (2 * WINDOW) + before + WINDOW, low)
    deep = np.flatnonzero(tree.depth == WINDOW)
    size = tree.last[deep] - tree.first[deep]
    members = tree.order[np.repeat(tree.first[deep] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    least[members] = np.repeat(tree.least[deep], size)
    return least


def without_repeated_windows(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by one space) of every document;
    null texts have no words. Short, repeated and long texts, ties and further columns: see repeats.py."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, spans in zip(column(b, "doc_id"), column(b, "text"), column(b, "spans"), strict=True):
                words = (text or b"").split()
                n = len(words)
                if spans:
                    words = [w for w, gone in zip(words, covered(n, spans).tolist(), strict=True) if not gone]
                data = b" ".join(words)
                rows.append((doc, n, n - len(words), hashlib.sha256(data).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return with_spans(docs, repeated_spans(docs, find)).select("doc_id", "text", "spans").mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_sha256 string")
