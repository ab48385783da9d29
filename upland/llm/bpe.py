"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

A leaf holds rank and place of the pair that begins there, a node the least of its two children, so
the root is the leftmost pair of the lowest rank. A merge changes three leaves (the pair before, the
pair itself, the pair that is gone) and their paths, until the root holds no mergeable pair.

Texts are cut first (see tokens.py), and a piece is merged once per worker while it is remembered. The
pretokens of a batch are merged together, their trees being rows of one array; long ones each by itself.

Defined cases: a null text is an empty one and has no ids; strings of added tokens in a text become
their ids, as in the library; ids decode to bytes, and bytes that aren't UTF-8 become U+FFFD; rows
without doc_id and repeated rows are encoded like others; a very long text is encoded whole; pairs of one rank are
merged from the left; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import column, plain, small_batches
from .tokens import PieceEncoder, byte_letters, kept, vocabulary

#: Fixed value: how byte-level vocabularies of this kind split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = 1 << 60


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        vocab: dict[str, int] = said["model"]["vocab"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.first = [vocab[c] for c in letters]
        self.merges = {(vocab[a] << 20) | vocab[b]: (rank << 20) | vocab[a + b] for rank, (a, b) in enumerate(map(tuple, (m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"])))}
        self.bytes = {i: bytes(of_letter[c] for c in token) for token, i in vocab.items()}
        self.added = {x["content"]: x["id"] for x in said.get("added_tokens") or []}
        self.bytes |= {i: text.encode() for text, i in self.added.items()}
        found = sorted(self.merges.items())
        self.keys, self.values = np.array([k for k, _ in found], np.int64), np.array([v for _, v in found], np.int64)
        self.first_ids = np.array(self.first, np.int64)
        self.pattern = regex.compile(PATTERN)
        self.cut_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pretoken."""
        ids = [self.first[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        merges = self.merges
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            if found := merges.get((ids[i] << 20) | ids[i + 1]):
                tree[size + i] = (found >> 20 << 32) | i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        while tree[1] != NONE:
            i = tree[1] & 0xFFFFFFFF
            j = after[i]
            ids[i] = merges[(ids[i] << 20) | ids[j]] & 0xFFFFF
            alive[j] = False
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            h = before[i]
            for at in (h, i, j):
                if at < 0:
                    continue
                value, leaf = NONE, size + at
                if at != j and after[at] < n and (found := merges.get((ids[at] << 20) | ids[after[at]])):
                    value = (found >> 20 << 32) | at
                if leaf >= 2 * size or tree[leaf] == value:
                    continue
                tree[leaf] = value
                while leaf > 1:
                    leaf >>= 1
                    a, b = tree[2 * leaf], tree[2 * leaf + 1]
                    least = a if a < b else b
                    if tree[leaf] == least:
                        break
                    tree[leaf] = least
        return [x for x, live in zip(ids, alive, strict=True) if live]

    def _pairs(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf values and merged ids of pairs a b at places `at`; NONE where they don't merge or don't fit."""
        key = (a << 20) | b
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.values[k]
        ok = fits & (self.keys[k] == key)
        return np.where(ok, (found >> 20 << 32) | at, NONE), found & 0xFFFFF

    def _merge_alike(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """merge() of many pretokens, one a row of bytes, with their trees as the rows of one array: (ids, which stay)."""
        m, width = data.shape
        leaves = 1 << max(width - 2, 0).bit_length()
        ids = np.zeros((m, leaves + 2), np.int64)
        ids[:, :width] = self.first_ids[data]
        row, at = np.arange(m), np.arange(leaves)
        tree = np.empty((m, 2 * leaves), np.int64)
        tree[:, leaves:], made = self._pairs(ids[:, :leaves], ids[:, 1 : leaves + 1], at, at + 1 < sizes[:, None])
        low = leaves
        while low > 1:
            tree[:, low // 2 : low] = np.minimum(tree[:, low : 2 * low : 2], tree[:, low + 1 : 2 * low : 2])
            low //= 2
        after = np.broadcast_to(np.arange(1, leaves + 3), (m, leaves + 2)).copy()
        before = np.broadcast_to(np.arange(-1, leaves + 1), (m, leaves + 2)).copy()
        stay = np.arange(leaves + 2) < sizes[:, None]
        while len(row := row[tree[row, 1] != NONE]):
            i, n = tree[row, 1] & 0xFFFFFFFF, sizes[row]
            j = after[row, i]
            k = after[row, j]
            h = before[row, i]
            ids[row, i] = made[row, i]
            stay[row, j] = False
            after[row, i] = k
            before[row, np.minimum(k, leaves + 1)] = np.where(k < n, i, before[row, np.minimum(k, leaves + 1)])
            own, own_made = self._pairs(ids[row, i], ids[row, np.minimum(k, leaves + 1)], i, k < n)
            prior, prior_made = self._pairs(ids[row, np.maximum(h, 0)], ids[row, i], h, h >= 0)
            tree[row, leaves + i], made[row, i] = own, own_made
            had = np.flatnonzero(h >= 0)
            tree[row[had], leaves + h[had]], made[row[had], h[had]] = prior[had], prior_made[had]
            gone = np.flatnonzero(j < leaves)
            tree[row[gone], leaves + j[gone]] = NONE
            for r, leaf in ((row, i), (row[had], h[had]), (row[gone], j[gone])):
                p = (leaves + leaf) >> 1
                while len(p) and p[0]:
                    tree[r, p] = np.minimum(tree[r, 2 * p], tree[r, 2 * p + 1])
                    p >>= 1
        return ids, stay

    def merge_many(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pretokens, one after the other, and how many each has."""
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        found: list[np.ndarray] = [None] * len(parts)  # type: ignore[list-item]
        counts = np.zeros(len(parts), np.int64)
        for width in (2, 3, 5, 9, 17, 33):
            rows = np.flatnonzero((n <= width) & (n > (width // 2 + 1 if width > 2 else 0)))
            for some in np.array_split(rows, max(1, len(rows) * width // 400_000)):
                if not len(some):
                    continue
                block = [parts[i] for i in some.tolist()]
                data = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in block]), np.uint8).reshape(-1, width)
                ids, stay = self._merge_alike(data, n[some])
                counts[some] = stay.sum(axis=1)
                for i, x in zip(some.tolist(), np.split(ids[stay], np.cumsum(counts[some])[:-1]), strict=True):
                    found[i] = x
        for i in np.flatnonzero(n > 33).tolist():
            found[i] = np.array(self.merge(parts[i]), np.int64)
            counts[i] = len(found[i])
        return np.concatenate(found).astype(np.uint32) if found else np.empty(0, np.uint32), counts

    def encode_many(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after the other, and how many each has."""
        parts: list[bytes] = []
        added: list[tuple[int, int]] = []  # place among the parts, id
        owners: list[int] = []
        for k, text in enumerate(pieces):
            if text.isascii() and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
                parts.append(text.encode())
                owners.append(k)
                continue
            at = 0
            for m in self.cut_added.finditer(text) if self.cut_added else ():
                own = self.pattern.findall(text[at : m.start()])
                parts += [x.encode() for x in own]
                added.append((len(parts), self.added[m[0]]))
                parts.append(b"\0")
                owners += [k] * (len(own) + 1)
                at = m.end()
            own = self.pattern.findall(text[at:])
            parts += [x.encode() for x in own]
            owners += [k] * len(own)
        ids, counts = self.merge_many(parts)
        if added:
            starts = np.cumsum(counts) - counts
            ids[starts[[a for a, _ in added]]] = [i for _, i in added]
        return ids, np.bincount(owners, weights=counts, minlength=len(pieces)).astype(np.int64)

    def _plain(self, text: str) -> list[int]:
        if text[1:].isalpha() and text.isascii() and (text[0] == " " or text[0].isalpha()):
            return self.merge(text.encode())
        return [i for part in self.pattern.findall(text) for i in self.merge(part.encode())]

    def encode(self, text: str) -> list[int]:
        if not self.cut_added or not (found := list(self.cut_added.finditer(text))):
            return self._plain(text) if text else []
        out, at = [], 0
        for m in found:
            out += self._plain(text[at : m.start()]) if m.start() > at else []
            out.append(self.added[m[0]])
            at = m.end()
        return out + (self._plain(text[at:]) if at < len(text) else [])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def _own(path: str) -> tuple[ByteBPE, PieceEncoder]:
    bpe = ByteBPE(path)
    return bpe, PieceEncoder(path, bpe.encode_many)


def encode_decode(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, n_tokens, ids (uint32 bytes, little-endian), decoded of every document."""
    small_batches(docs.sparkSession)
    path = vocabulary(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept(("own", path), lambda: _own(path)) as (bpe, encoder):
            for b in batches:
                ids = encoder.texts(column(b, "text"))
                cols = [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array([bpe.decode(x.tolist()) for x in ids], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids", "decoded"])

    return plain(docs).mapInArrow(work, "doc_id long, n_tokens long, ids binary, decoded string")
