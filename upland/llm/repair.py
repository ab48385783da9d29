"""Token ids in grammar-compressed shards (Re-Pair), with random access.

Documents are encoded in ascending doc_id order (range partitions, sorted) and gathered to shards of
about SHARD_TOKENS ids, each document ended by an end id. In a shard, frequent pairs of neighbours are
replaced by nonterminals until no pair is left that pays, that is, whose rule takes less room than it saves (LEAST
occurrences). Pairs are replaced in rounds: of pairs that overlap, the one found more often goes first, and a pair whose
places, less those that went to others, no longer pay waits for the next round. After the first round only
places beside a replaced pair or with a pair that waits are looked at. No pair reaches over the end of a document.

A shard is a file of its own, written and read by Spark, so on any file system that Spark has:

    "RPR2", then as little-endian u32: base (first nonterminal), rules, documents, symbols, ids, bytes of the body
    body, packed by zstd:
        rules:     left and right, for base, base + 1, ...: low u16 of all, then high u8
        lengths:   u32, ids that each rule expands to
        documents: u64 doc_id (two's complement), u8 whether it is null, u32 first symbol, u32 first id
        symbols:   low u16 of all, then high u8
    a line end

Files are named by partition and number, which is their order. read_range() expands only the symbols that hold
the wanted ids; read_shards() gets documents by it.

Defined cases: a null or empty text has the end id only; rows without doc_id come first; repeated rows
are kept, equal doc_ids in order of their texts; a document longer than a shard has a shard to itself; an empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, materialize, plain, shared_dir, small_batches
from .tokens import library, shared_encoder, vocabulary

END = 1
SHARD_TOKENS = 2_000_000
#: Bytes of a symbol and of a rule with its length; a pair pays from LEAST occurrences on.
SYMBOL_BYTES, RULE_BYTES = 3, 10
LEAST = RULE_BYTES // SYMBOL_BYTES + 1
#: Bytes of text that are encoded at once.
ENCODED = 8 << 20
#: Documents that are read at once.
READ = 64
#: Shards whose places are broadcast, at most (24 bytes each).
BROADCAST_SHARDS = 200_000
HEAD = struct.Struct("<4s6I")


def _waiting(now: np.ndarray, after: np.ndarray, at: np.ndarray | None, used: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Codes (left and right symbol) of the pairs at the places at (None: all), sorted, with their places, the bits of a symbol,
    and places left out: in runs of one symbol, pairs overlap, and every second one counts."""
    end = len(now) - 1
    if at is None:
        at = np.flatnonzero(after[:end] < end)
        left, right = now.take(at), now.take(at + 1)
    else:
        second = after.take(at)
        linked = np.flatnonzero(second < end)
        at, second = at.take(linked), second.take(linked)
        left, right = now.take(at), now.take(second)
    alike, odd = np.flatnonzero(left == right), np.empty(0, np.int64)
    if len(alike):
        run = at[alike]
        first = np.flatnonzero(np.append(True, after[run[:-1]] != run[1:]))
        place = np.arange(len(run)) - np.repeat(first, np.diff(np.append(first, len(run))))
        odd = alike[place % 2 == 1]
    bits, place_bits = int(used).bit_length(), end.bit_length()
    if 2 * bits + place_bits >= 64:
        raise ValueError("the shard is too long")
    # sorted with the place in the low bits, which is quicker than to sort places by codes; pairs that don't count go to the end
    code = left.astype(np.uint64)
    code <<= np.uint64(bits)
    code |= right
    code <<= np.uint64(place_bits)
    code |= at.astype(np.uint64)
    code[odd] = np.iinfo(np.uint64).max
    skipped = at[odd]
    code.sort()
    code = code[: len(code) - len(odd)]
    at = (code & np.uint64((1 << place_bits) - 1)).astype(np.int32)
    code >>= np.uint64(place_bits)
    return code, at, bits, skipped


def compress(symbols: np.ndarray, ends: np.ndarray, base: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first symbol of each document, rules as rows of two) for ids below base; ends: each document's last id."""
    n = len(symbols)
    if not n:
        return np.empty(0, np.uint32), np.empty(0, np.int64), np.empty((0, 2), np.uint32)
    # places are linked; n stands for "none", and no link crosses the end of a document
    now = np.append(symbols, 0).astype(np.uint32)
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    after[[*ends, n]] = n
    before[[0, *(ends[:-1] + 1)]] = n
    gone, alive, rank = np.zeros(n + 1, bool), np.zeros(n + 1, bool), np.zeros(n + 1, np.int32)
    at, used, rules = None, base, [np.empty((0, 2), np.uint32)]
    while True:
        code, at, bits, skipped = _waiting(now, after, at, used)
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.empty(0, np.int64)
        counts = np.diff(np.append(first, len(code)))
        often = counts >= least
        if not often.any():
            break
        at, pair, counts = at.compress(np.repeat(often, counts)), code[first[often]], counts[often]
        del code
        # a pair's rank is higher the more often it is found; where pairs overlap, the higher rank stays
        order = np.lexsort((pair, counts))
        ranks = np.empty(len(order), np.int32)
        ranks[order] = np.arange(1, len(order) + 1)
        # sorted by place, with the rank in the low bits, as memory is then gone through in order
        placed = at.astype(np.int64)
        placed <<= 32
        placed |= np.repeat(ranks, counts)
        placed.sort()
        at, own = placed >> 32, placed.astype(np.int32)
        rank[at] = own
        stays = (own > rank.take(before.take(at))) & (own > rank.take(after.take(at)))
        rank[at] = 0
        stays = np.flatnonzero(stays)
        chosen, own = at.take(stays), own.take(stays)
        pays = np.bincount(own, minlength=len(order) + 1) >= least
        taken = np.flatnonzero(pays)[::-1]
        number = np.zeros(len(pays), np.uint32)
        number[taken] = used + np.arange(len(taken))
        if not pays[1:].all():
            paid = np.flatnonzero(pays.take(own))
            chosen, own = chosen.take(paid), own.take(paid)
        made = pair[order[taken - 1]]
        rules.append(np.stack([made >> np.uint64(bits), made & np.uint64((1 << bits) - 1)], 1).astype(np.uint32))
        used += len(taken)
        second = after.take(chosen)
        third = after.take(second)
        now[chosen], after[chosen], before[third], gone[second] = number.take(own), third, chosen, True
        beside = before.take(chosen)
        # a run's other places count once its head is gone
        alive[at] = alive[chosen] = alive[beside] = alive[skipped] = True
        alive[second] = alive[n] = False
        if len(chosen) > n // 64:
            at = np.flatnonzero(alive)
        else:
            at = np.sort(np.concatenate([at, chosen, beside, skipped]))
            at = at.compress(alive.take(at) & np.append(True, at[1:] != at[:-1]))
        alive[at] = False
    stay = np.flatnonzero(~gone[:n])
    starts = np.append(0, ends[:-1] + 1)
    return now.take(stay), np.searchsorted(stay, starts), np.concatenate(rules)


def rule_levels(rules: np.ndarray, base: int) -> list[tuple[int, int]]:
    """Stretches of rules that name only what comes before the stretch."""
    newest, out, at = rules.max(axis=1, initial=0).astype(np.int64) - base, [], 0
    while at < len(rules):
        later = newest[at:] >= at
        stop = at + int(np.argmax(later)) if later.any() else len(rules)
        out.append((at, stop))
        at = stop
    return out


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    lengths = np.ones(base + len(rules), np.int64)
    for a, b in rule_levels(rules, base):
        lengths[base + a : base + b] = lengths[rules[a:b]].sum(axis=1)
    return lengths


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2^24: the low 16 bits of all, then the high 8."""
    return (x & 0xFFFF).astype("<u2").tobytes() + (x >> 16).astype(np.uint8).tobytes()


def build_image(docs: list[int | None], ids: list[np.ndarray], base: int) -> bytes:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate(ids)
    symbols, first, rules = compress(flat, np.cumsum(sizes) - 1, base)
    if base + len(rules) > 1 << 24:
        raise ValueError("the format holds symbols of 24 bits")
    known = np.array([x or 0 for x in docs], np.int64)
    parts = [rule_lengths(rules, base)[base:].astype("<u4"), known.astype("<i8"), np.array([x is None for x in docs], np.uint8), first.astype("<u4"), (np.cumsum(sizes) - sizes).astype("<u4")]
    body = zstandard.ZstdCompressor(level=1).compress(_planes(rules.ravel()) + b"".join(x.tobytes() for x in parts) + _planes(symbols))
    return HEAD.pack(b"RPR2", base, len(rules), len(docs), len(symbols), len(flat), len(body)) + body


def image_ids(data: bytes) -> int:
    """How many ids an image holds, by its head."""
    magic, _, _, _, _, n, _ = HEAD.unpack_from(data)
    if magic != b"RPR2":
        raise ValueError("not a shard image")
    return n


class Image:
    """A shard read back."""

    def __init__(self, data: bytes):
        self.n_ids = image_ids(data)
        _, self.base, n_rules, n_docs, n_symbols, _, size = HEAD.unpack_from(data)
        raw, at = zstandard.ZstdDecompressor().decompress(data[HEAD.size : HEAD.size + size]), 0

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        def planes(n: int) -> np.ndarray:
            return part("<u2", n).astype(np.int64) | part("u1", n).astype(np.int64) << 16

        self.rules = planes(2 * n_rules).reshape(-1, 2)
        lengths = part("<u4", n_rules).astype(np.int64)
        docs, null = part("<i8", n_docs), part("u1", n_docs)
        self.docs = [None if n else d for d, n in zip(docs.tolist(), null.tolist(), strict=True)]
        self.first_symbol, self.first_id = part("<u4", n_docs).astype(np.int64), part("<u4", n_docs).astype(np.int64)
        self.symbols = planes(n_symbols)
        self.size = np.concatenate([np.ones(self.base, np.int64), lengths])
        # expansions of all rules, one after the other; a level of rules is laid out from those before it
        self.offset = np.concatenate([np.arange(self.base), self.base + np.cumsum(lengths) - lengths])
        self.table = np.empty(self.base + int(lengths.sum()), np.uint32)
        self.table[: self.base] = np.arange(self.base)
        for a, b in rule_levels(self.rules, self.base):
            start = self.offset[self.base + a]
            laid = self.expand(self.rules[a:b].ravel())
            self.table[start : start + len(laid)] = laid
        self.ends = np.cumsum(self.size[self.symbols])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        size = self.size.take(symbols)
        ends = np.cumsum(size)
        at = np.repeat(self.offset.take(symbols) - (ends - size), size)
        at += np.arange(len(at))
        return self.table.take(at)

    def read_range(self, start: int, n: int) -> np.ndarray:
        """Ids start .. start + n of the shard."""
        i, j = int(np.searchsorted(self.ends, start, "right")), int(np.searchsorted(self.ends, start + n, "left"))
        skip = start - (int(self.ends[i - 1]) if i else 0)
        return self.expand(self.symbols[i : j + 1])[skip : skip + n]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Every document's ids, some documents at a time."""
        bounds = np.append(self.first_id, self.n_ids)
        for k in range(0, len(self.docs), READ):
            stop = min(k + READ, len(self.docs))
            ids = self.read_range(int(bounds[k]), int(bounds[stop] - bounds[k]))
            for d in range(k, stop):
                yield self.docs[d], ids[bounds[d] - bounds[k] : bounds[d + 1] - bounds[k]]


def write_shards(docs: DataFrame, folder: str | None = None, tokenizer: str = "word_bpe_49k.json", end: int = END, shard_tokens: int = SHARD_TOKENS) -> str:
    """Write a file for each shard to a folder, by default a new one in the shared folder; returns the folder."""
    spark = docs.sparkSession
    small_batches(spark)
    path = vocabulary(tokenizer)
    base = library(path).get_vocab_size(with_added_tokens=True)
    folder = folder or f"{shared_dir(spark).rstrip('/')}/upland-shards-{uuid.uuid4().hex}"

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            image = build_image([x[0] for x in held], [x[1] for x in held], base)
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array([image], pa.binary())], ["image"])

        def runs() -> Iterator[tuple[list[int | None], list[bytes | None]]]:
            """The documents, at least ENCODED bytes of text at once: a word is looked up once in all of them."""
            docs, texts, n = [], [], 0
            for b in batches:
                docs += column(b, "doc_id")
                texts += column(b, "text")
                n += b.nbytes
                if n >= ENCODED:
                    yield docs, texts
                    docs, texts, n = [], [], 0
            yield docs, texts

        with shared_encoder(path) as encoder:
            for known, texts in runs():
                for doc, ids in zip(known, encoder.texts(texts), strict=True):
                    if held and size + len(ids) >= shard_tokens:
                        yield flush()
                    held.append((doc, np.append(ids, np.uint32(end))))
                    size += len(ids) + 1
            if held:
                yield flush()

    ordered = plain(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # the text writer writes bytes as they are; one record a file
    images = ordered.mapInArrow(shards, "image binary").select(F.col("image").cast("string").alias("value"))
    images.write.option("maxRecordsPerFile", 1).option("compression", "none").text(folder)
    return folder


def shard_files(spark: SparkSession, folder: str) -> DataFrame:
    """part, shard (their order), image of the files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).where("length > 1")
    number = lambda k: F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)[^/]*$", k).cast("int")
    return files.select(number(1).alias("part"), number(2).alias("shard"), F.col("content").alias("image"))


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents, from the files alone."""
    files = shard_files(spark, folder)

    # the ids that an image holds, by its head (see HEAD), which needs no Python worker
    byte = lambda k: F.conv(F.hex(F.substring("image", k + 1, 1)), 16, 10).cast("long")
    n_ids = sum((byte(20 + k) * 256**k for k in range(1, 4)), byte(20))
    whole = F.when(F.substring("image", 1, 4) == F.lit(b"RPR2"), n_ids).otherwise(F.raise_error(F.lit("not a shard image")).cast("long"))
    counted = materialize(files.select("part", "shard", whole.alias("n")))
    # a row for each partition that wrote, then a running sum within each
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = counted.groupBy("part").agg(F.sum("n").alias("n")).select("part", before.alias("base"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = materialize(counted.withColumn("inside", inside).join(parts, "part").select("part", "shard", (F.col("base") + F.col("inside")).alias("base")))
    bases = F.broadcast(bases) if bases.count() <= BROADCAST_SHARDS else bases.hint("merge")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, data in zip(column(b, "base"), column(b, "image"), strict=True):
                rows = []
                for doc, ids in Image(data).documents():
                    rows.append((doc, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.join(bases, ["part", "shard"]).select("base", "image").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
