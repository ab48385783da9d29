"""Token ids of whole texts, worked out once per distinct piece of text.

Both public vocabularies cut a text into pretokens before any merge, and no pretoken of theirs
reaches across the cuts made here, so a piece always has the same ids and a worker keeps them:

- byte-level vocabulary: a cut before each space that a non-space follows. A pretoken there begins
  with that space (one space and a word, a number or signs); white space before it ends earlier, as
  the rule for white space leaves the last one to the word.
- word vocabulary: a cut at each run of ASCII white space, which the vocabulary drops.

The ids of a piece are the tokenizers library's own (or another encoder's, handed in).
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import itertools
import json
import os
import re
import string
import threading
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: Pieces that a worker remembers; beyond it, those seen once only are forgotten, or all if that isn't enough.
MEMORY = 450_000
#: Seconds after which an idle worker drops what it remembers.
IDLE_S = 2.0
#: Pieces joined to one text for the library.
JOINED = 1000
#: ASCII signs: in the word vocabulary a run of them is one pretoken.
SIGNS = string.punctuation.encode()


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


SPACE_LETTER = byte_letters()[0x20]
#: A space at the end or before a byte that white space may begin with: there the quick way of cutting doesn't hold.
_ODD = re.compile(rb" (?:[\x09-\x0d\x1c-\x20\xc2\xe1\xe2\xe3]|\Z)")
_CUT = re.compile(r"(?= [^\s])")


def vocabulary(name: str) -> str:
    """Path of a vocabulary file: a path as it is, or the name of a public tokenizer's file."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def library(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Pieces to their ids, one after the other, and how many each has.
Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def _laid(found: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum())), sizes


def library_encoder(path: str, kind: str = "whole") -> Encoder:
    """The library's encoder. Pieces that may be cut are joined to longer texts again, as it is quicker
    with few long texts; each piece's share of the ids is found by lengths or ends of words."""
    tokenizer = library(path)
    if kind == "whole":
        return lambda pieces: _laid([x.ids for x in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)])
    vocab = tokenizer.get_vocab(with_added_tokens=False)
    n_ids = tokenizer.get_vocab_size(with_added_tokens=True)

    def run_ids(texts: list[str], by: Tokenizer = tokenizer) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in by.encode_batch_fast(texts, add_special_tokens=False)]

    # words of the letters A-Z and a-z are pretokens as they are, so they go to the model without the search for pretokens
    bare = library(path)
    bare.normalizer, bare.pre_tokenizer = None, pre_tokenizers.Split("\n", "removed")

    if kind == "byte":
        n_bytes = np.zeros(n_ids, np.int64)
        for token, i in vocab.items():
            n_bytes[i] = len(token)  # a letter for each byte
        for i, token in tokenizer.get_added_tokens_decoder().items():
            n_bytes[i] = len(token.content.encode())

        def by_length(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(np.cumsum(n_bytes[ids]), np.cumsum(lengths)) + 1, prepend=0)

        def simple_byte(x: str) -> bool:
            return x[0] == " " and _is_word(x[1:])

        def plain_byte(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids = np.concatenate(run_ids([_letters("\n".join(pieces[i : i + JOINED])) for i in range(0, len(pieces), JOINED)], bare))
            return ids, by_length(ids, np.fromiter(map(len, map(str.encode, pieces)), np.int64, len(pieces)))

        def others_byte(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            # a piece without a space before it can only begin a text
            heads = [i for i, x in enumerate(pieces) if x[0] != " "]
            cuts = sorted({*heads, *(i + 1 for i in heads), *range(0, len(pieces), JOINED), len(pieces)})
            ids = np.concatenate(run_ids(["".join(pieces[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]))
            return ids, by_length(ids, np.fromiter(map(len, map(str.encode, pieces)), np.int64, len(pieces)))

        return _either(simple_byte, plain_byte, others_byte)

    is_end = np.zeros(n_ids, bool)
    is_end[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def plain(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One word each, which has one end."""
        ids = np.concatenate(run_ids([_letters("\n".join(pieces[i : i + JOINED])) for i in range(0, len(pieces), JOINED)], bare))
        return ids, np.diff(np.flatnonzero(is_end[ids]) + 1, prepend=0)

    def others(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        runs = [pieces[i : i + JOINED] for i in range(0, len(pieces), JOINED)]
        found = tokenizer.encode_batch([" ".join(r) for r in runs], add_special_tokens=False)
        sizes = []
        for run, x in zip(runs, found, strict=True):
            starts = np.cumsum([0] + [len(y) + 1 for y in run[:-1]])
            owner = np.searchsorted(starts, np.fromiter((y[0] for y in x.offsets), np.int64, len(x)), "right") - 1
            sizes.append(np.bincount(owner, minlength=len(run)))
        return np.concatenate([np.array(x.ids, np.uint32) for x in found]), np.concatenate(sizes)

    return _either(lambda x: _SMALL(x) is not None, plain, others)


#: Small letters of the Latin alphabets only, in form NFC.
_SMALL_LETTERS = f"[{''.join(x for x in map(chr, range(0x250)) if x.isalpha() and x.islower() and unicodedata.is_normalized('NFC', x))}]+"
_SMALL = re.compile(_SMALL_LETTERS).fullmatch


def _is_word(x: str) -> bool:
    """Whether x is letters of the Latin alphabets only, which every table of letters knows: one pretoken."""
    return x.isalpha() and (x.isascii() or max(x) < "\u0250")


#: Bytes of a-z and of the letters U+00C0 to U+023F.
_LATIN = string.ascii_lowercase.encode() + bytes(range(0x80, 0xC0)) + bytes(range(0xC3, 0xC9))


def _lowered(word: bytes) -> bytes | None:
    """The word with small letters, None if it isn't letters only: a letter may give a letter and a mark when lowered."""
    if word.translate(None, _LATIN):
        return None
    given = word.decode("utf-8", "replace")
    low = given.lower()
    return low.encode() if _is_word(given) and _is_word(low) else None


#: What stands for each byte in byte-level vocabularies, but for the line end, which parts pieces here.
_LETTERS = {b: x for b, x in enumerate(byte_letters()) if b != 10}


def _letters(text: str) -> str:
    return text.replace(" ", SPACE_LETTER) if text.isascii() else text.encode().decode("latin-1").translate(_LETTERS)


def _either(test: Callable[[str], bool], yes: Encoder, no: Encoder) -> Encoder:
    """The encoder that gives pieces to one of two, by a test."""

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        simple = np.fromiter(map(test, pieces), bool, len(pieces))
        parts = [(f, np.flatnonzero(m)) for f, m in ((yes, simple), (no, ~simple)) if m.any()]
        done = [f([pieces[i] for i in at.tolist()]) for f, at in parts]
        flat = np.concatenate([x[0] for x in done])
        starts, sizes, used = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64), 0
        for (_, at), (ids, n) in zip(parts, done, strict=True):
            starts[at], sizes[at] = used + np.cumsum(n) - n, n
            used += len(ids)
        return gather(flat, starts, sizes), sizes

    return encode


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of flat, one after the other."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return flat.take(at)


def cut_kind(path: str) -> str:
    """'byte', 'word' or 'whole': how texts may be cut for this vocabulary, by its own description."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    added, pre, norm = said.get("added_tokens") or [], said.get("pre_tokenizer") or {}, said.get("normalizer")
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] or re.search(r"\s", x["content"]) for x in added):
        return "whole"
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "byte"
    parts = pre.get("pretokenizers") or []
    steps = [x["type"] for x in (norm or {}).get("normalizers", [])]
    # the pattern's own matches are kept and hold no white space; NFC and lower case don't reach across it
    if [x["type"] for x in parts] == ["Split", "ByteLevel"] and parts[0]["invert"] and parts[0]["behavior"] == "Removed" and parts[0]["pattern"].get("Regex", "").endswith(r"|[^\s\p{L}\p{N}]+") and steps == ["NFC", "Replace", "Lowercase"] and not parts[1]["use_regex"]:
        return "word"
    return "whole"


def cut(text: bytes, kind: str) -> tuple[list[bytes], list[bytes]]:
    """Pieces that have their ids each for itself: those as they are, which come first, and then those
    without the space that begins them."""
    if kind == "whole" or not text:
        return [text] if text else [], []
    if _ODD.search(text):
        first, *rest = _CUT.split(text.decode("utf-8", "replace"))
        if first[:1] == " " and first[1:2].strip():
            first, rest = "", [first, *rest]
        return [first.encode()] if first else [], [x[1:].encode() for x in rest]
    first, *rest = text.split(b" ")
    return [first] if first else [], rest


class _Numbers(dict):
    """Numbers pieces as they come; shared counts those of both kinds, joints gets what is put together. A comma or full stop after a letter is a
    pretoken of its own, so such a piece is put together from two. In the word vocabulary, so is any run of signs after
    letters only; case doesn't count there, so letters are lowered."""

    def __init__(self, shared: list, joints: list, lead: str, ends: dict, lower: bool):
        super().__init__()
        self.shared, self.joints, self.lead, self.ends, self.lower = shared, joints, lead, ends, lower

    def __missing__(self, piece: bytes) -> int:
        parts = None
        if self.lower:
            core = piece.rstrip(SIGNS)
            low = core.lower() if core.isalpha() else _lowered(core)
            if low and len(core) < len(piece):
                parts = self[low], self.ends[piece[len(core) :]]
            elif low and low != piece:
                self[piece] = n = self[low]
                return n
        if parts is None and piece[-1:] in (b",", b".") and piece[-2:-1].isalpha():
            parts = self[piece[:-1]], self.ends[piece[-1:]]
        n = self[piece] = len(self.shared)
        if parts is None:
            self.shared.append(self.lead + piece.decode("utf-8", "replace"))
        else:
            self.shared.append(None)
            self.joints += (n, *parts)
        return n


def _strings(words: pa.Array) -> list[bytes]:
    """Words without spaces as bytes: one string of them is quicker to take apart than an array."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ").view(pa.binary())[0].as_py().split(b" ")


class PieceEncoder:
    """Ids of texts; made once per worker."""

    def __init__(self, path: str, encode: Encoder | None = None):
        self.kind = cut_kind(path)
        self.encode = encode or library_encoder(path, self.kind)
        self._clear()

    def _clear(self) -> None:
        # joints: of each new piece that is put together, its number and those of its two parts
        self.pieces: list = []
        self.joints: list = []
        self.heads = _Numbers(self.pieces, self.joints, "", {}, self.kind == "word")
        self.heads.ends = self.heads
        self.tails = _Numbers(self.pieces, self.joints, " ", self.heads, False)
        self.flat, self.starts, self.sizes, self.seen = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _forget(self) -> None:
        keep = self.seen > 1
        if keep.sum() > MEMORY // 2:
            return self._clear()
        renumbered = np.where(keep, np.cumsum(keep) - 1, -1)
        for name in ("heads", "tails"):
            known = getattr(self, name)
            fresh = _Numbers(self.pieces, self.joints, known.lead, {}, known.lower)
            words, numbers = list(known), renumbered[np.fromiter(known.values(), np.int64, len(known))]
            kept = np.flatnonzero(numbers >= 0)
            fresh.update(zip([words[i] for i in kept.tolist()], numbers[kept].tolist(), strict=True))
            setattr(self, name, fresh)
        self.heads.ends = self.tails.ends = self.heads
        self.flat = gather(self.flat, self.starts[keep], self.sizes[keep])
        self.sizes, self.seen = self.sizes[keep], np.zeros(keep.sum(), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        del self.pieces[len(self.sizes) :]

    def _words(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts' words, one after the other, and how many words each text has. Arrow parts them at white
        space and tells them apart, so that a word is looked up once for all its places. Case doesn't count but in the
        strings of added tokens."""
        given = pa.array(texts, pa.binary()).view(pa.string())
        low = pc.ascii_lower(given)
        if any(x and b"<|" in x for x in texts):
            low = pc.if_else(pc.match_substring(given, "<|"), given, low)
        low = pc.ascii_trim_whitespace(low)
        parted = pc.ascii_split_whitespace(pc.if_else(pc.equal(pc.binary_length(low), 0), pa.scalar(None, pa.string()), low))
        coded = parted.flatten().dictionary_encode()
        counts = pc.fill_null(pc.list_value_length(parted), 0).to_numpy(zero_copy_only=False)
        known = coded.dictionary
        if not len(known):
            return np.empty(0, np.int64), counts
        words = _strings(known)
        numbers = np.fromiter(map(self.heads.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        # new words of small letters only, also with signs behind them, are numbered all at once
        fresh = known.take(pa.array(new))
        core = pc.ascii_rtrim(fresh, characters=SIGNS.decode())
        small = pc.match_substring_regex(core, f"^{_SMALL_LETTERS}$").to_numpy(zero_copy_only=False)
        size = pc.binary_length(core).to_numpy()
        bare = size == pc.binary_length(fresh).to_numpy()
        plain, joined, others = new[small & bare], np.flatnonzero(small & ~bare), new[~small]
        numbers[plain] = self._add([words[i] for i in plain.tolist()])
        if len(joined):
            cores = _strings(core.take(pa.array(joined)))
            self._add([x for x in dict.fromkeys(cores) if x not in self.heads])
            whole = [words[i] for i in new[joined].tolist()]
            signs = [self.heads[x[n:]] for x, n in zip(whole, size[joined].tolist(), strict=True)]
            at = range(len(self.pieces), len(self.pieces) + len(whole))
            self.joints += itertools.chain.from_iterable(zip(at, map(self.heads.__getitem__, cores), signs, strict=True))
            self.heads.update(zip(whole, at, strict=True))
            self.pieces += itertools.repeat(None, len(whole))
            numbers[new[joined]] = at
        numbers[others] = [self.heads[words[i]] for i in others.tolist()]
        return numbers.take(coded.indices.to_numpy()), counts

    def _add(self, words: list[bytes]) -> range:
        """The numbers that new words of small letters only get."""
        at = range(len(self.pieces), len(self.pieces) + len(words))
        if words:
            self.heads.update(zip(words, at, strict=True))
            self.pieces += b" ".join(words).decode().split(" ")
        return at

    def _cut(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts' pieces, one after the other, and how many pieces each text has."""
        head, tail = self.heads.__getitem__, self.tails.__getitem__
        found = []
        for x in texts:
            first, rest = cut(x, self.kind) if x else ([], [])
            found.append(np.array([*map(head, first), *map(tail, rest)], np.int64))
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def texts(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text (UTF-8) as uint32; null is the empty text."""
        if not texts:
            return []
        if len(self.pieces) > MEMORY:
            self._forget()
        every, counts = self._words(texts) if self.kind == "word" else self._cut(texts)
        learnt = len(self.starts)
        if new := self.pieces[learnt:]:
            joints = np.array(self.joints, np.int64).reshape(-1, 3)
            self.joints.clear()
            whole = np.ones(len(new), bool)
            whole[joints[:, 0] - learnt] = False
            ids, n = self.encode([x for x in new if x is not None]) if whole.any() else (self.flat[:0], self.sizes[:0])
            starts, sizes = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
            starts[whole], sizes[whole] = len(self.flat) + np.cumsum(n) - n, n
            self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, ids])
            if len(joints):
                at, parts = joints[:, 0], joints[:, 1:]
                size = self.sizes[parts]
                total = size.sum(axis=1)
                self.starts[at], self.sizes[at] = len(self.flat) + np.cumsum(total) - total, total
                self.flat = np.concatenate([self.flat, gather(self.flat, self.starts[parts].ravel(), size.ravel())])
            self.pieces[learnt:] = [None] * len(new)  # only their number counts now
            self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int64)])
        self.seen += np.bincount(every, minlength=len(self.seen))
        sizes = self.sizes.take(every)
        ids = gather(self.flat, self.starts.take(every), sizes)
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]


class _Kept:
    """One thing that a worker process keeps for its next task; an idle worker drops it and gives the memory back."""

    def __init__(self):
        self.lock, self.key, self.value, self.timer = threading.Lock(), None, None, None

    @contextlib.contextmanager
    def lend(self, key: tuple, make: Callable[[], object]) -> Iterator:
        with self.lock:
            if self.timer:
                self.timer.cancel()
                self.timer = None
            if self.key != key:
                self.key, self.value = key, None
                self.value = make()
            value = self.value
        try:
            yield value
        finally:
            del value
            with self.lock:
                self.timer = threading.Timer(IDLE_S, self.drop)
                self.timer.daemon = True
                self.timer.start()

    def drop(self) -> None:
        with self.lock:
            if self.timer is None:
                return  # lent again meanwhile
            self.key = self.value = self.timer = None
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)


_KEPT = _Kept()


def kept(key: tuple, make: Callable[[], object]) -> contextlib.AbstractContextManager:
    """What make() gives, for the time of a task; later tasks of the worker with the same key get the same."""
    return _KEPT.lend(key, make)


def let_go() -> None:
    """Drop what this worker keeps at once, for a task that has no use for it but needs the memory."""
    _KEPT.drop()


def shared_encoder(path: str) -> contextlib.AbstractContextManager:
    return kept(("library", path), lambda: PieceEncoder(path))
