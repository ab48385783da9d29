import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, corpus, docs
from hypothesis import given, settings
from hypothesis import strategies as st

import upland.llm.repair as R
import upland.llm.tokens as T
from upland.llm.bpe import ByteBPE, encode_decode
from upland.llm.packing import pack, plan
from upland.llm.tokens import PieceEncoder, cut_kind, library, vocabulary

BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
LETTERS = list("ab'sZé \n\t\r\x0b\x1c\x85\xa0   ..1٣'llΣς́İ你🙂‍\x00") + ["<|endoftext|>", "<|startoftext|>", " <|endoftext|> ", "'S", "'re", " the"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_have_the_librarys_ids(path):
    rng = random.Random(3)
    texts = ["".join(rng.choices(LETTERS, k=rng.randrange(30))) for _ in range(20_000)] + [t or "" for _, t, _ in corpus()]
    assert cut_kind(path) in ("byte", "word")
    encoder = PieceEncoder(path)
    got = [x.tolist() for i in range(0, len(texts), 5000) for x in encoder.texts([t.encode() for t in texts[i : i + 5000]])]
    assert got == [x.ids for x in library(path).encode_batch_fast(texts, add_special_tokens=False)]
    encoder._forget()
    assert [x.tolist() for x in encoder.texts([t.encode() for t in texts[:2000]])] == got[:2000]


def test_segment_tree_merges_as_the_library():
    rng = random.Random(4)
    bpe, lib = ByteBPE(BYTE), library(BYTE)
    for _ in range(5000):
        t = "".join(rng.choices(LETTERS, k=rng.randrange(40)))
        ids = lib.encode(t, add_special_tokens=False).ids
        assert bpe.encode(t) == ids and bpe.decode(ids) == lib.decode(ids, skip_special_tokens=False)
    t = "ab" * 30_000
    assert bpe.encode(t) == lib.encode(t, add_special_tokens=False).ids
    assert bpe.decode([bpe.first[0xC3], bpe.first[0x28]]) == "�("


def test_encode_decode(spark):
    rows, lib = corpus(), library(BYTE)
    want = []
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in encode_decode(clashing(docs(spark, rows))).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert encode_decode(docs(spark, [])).count() == 0


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_shards_read_back(spark, monkeypatch, tmp_path, broadcast):
    monkeypatch.setattr(R, "BROADCAST_SHARDS", broadcast)
    rows, lib = corpus(), library(WORD)
    folder = R.write_shards(clashing(docs(spark, rows)), str(tmp_path / "shards"), shard_tokens=3000)
    files = sorted(x for x in (tmp_path / "shards").iterdir() if x.name.startswith("part-"))
    assert len(files) > 3 and all(x.read_bytes()[:4] == b"RPR2" for x in files)
    got = sorted(map(tuple, R.read_shards(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i))
    start, by = 0, {}
    for doc, at, n, crc in got:
        assert at == start
        start += n
        by.setdefault(doc, []).append((n, crc))
    for doc in {i for i, _, _ in rows}:
        ids = [np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t, _ in rows if i == doc]
        assert sorted(by[doc]) == sorted((len(x), zlib.crc32(x.tobytes())) for x in ids)
    assert R.read_shards(spark, R.write_shards(docs(spark, []))).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=60), min_size=1, max_size=8), st.randoms())
def test_grammar_round_trip_and_random_access(parts, rng):
    ids = [np.array(p, np.uint32) for p in parts]
    flat = np.concatenate(ids)
    for least in (2, R.LEAST):
        symbols, first, rules = R.compress(flat, np.cumsum([len(x) for x in ids]) - 1, 5, least)
        lengths = R.rule_lengths(rules, 5)
        assert lengths[symbols].sum() == len(flat) and len(first) == len(ids)
        # no pair is left that pays, in any document
        many = Counter()
        for a, b in zip(first, [*first[1:], len(symbols)], strict=True):
            part, k = symbols[a:b].tolist(), 0
            for x, run in itertools.groupby(part):
                k = len(list(run))
                many[x, x] += k // 2
            many.update((x, y) for x, y in zip(part, part[1:], strict=False) if x != y)
        assert max(many.values(), default=0) < least
    image = R.Image(R.build_image([None, *range(len(ids) - 1)], ids, 5))
    assert all((a[1] == b).all() and len(a[1]) == len(b) for a, b in zip(image.documents(), ids, strict=True))
    at = rng.randrange(len(flat))
    n = rng.randrange(1, len(flat) - at + 1)
    assert (image.read_range(at, n) == flat[at : at + n]).all()


def test_runs_whose_head_is_replaced():
    symbols, _, rules = R.compress(np.array([1, 0, 1, 0, 0, 0, 0, 0], np.uint32), np.array([7]), 5, least=2)
    assert rules.tolist() == [[1, 0], [0, 0]] and symbols.tolist() == [5, 5, 6, 6]


def test_repeats_become_rules():
    text = np.tile(np.array([1, 2, 3, 4], np.uint32), 500)
    symbols, _, rules = R.compress(text, np.array([len(text) - 1]), 10, least=2)
    assert len(symbols) < 20 and len(rules) < 15


@settings(max_examples=150, deadline=None)
@given(st.integers(3, 40).flatmap(lambda room: st.tuples(st.just(room), st.lists(st.integers(1, room), max_size=200))))
def test_plan_places_everything(case):
    room, lengths = case
    counts = np.bincount(lengths, minlength=room + 1) if lengths else np.zeros(room + 1, int)
    got = np.zeros(room + 1, int)
    for found, times in plan(counts, room):
        assert times > 0 and sum(found) <= room
        for x in found:
            got[x] += times
    assert (got == counts).all()


def test_plan_finds_exact_fits():
    counts = np.zeros(101, int)
    for x in (60, 40, 55, 30, 15, 50, 25, 20, 5):
        counts[x] += 7
    assert sum(t for _, t in plan(counts, 100)) == 21


def test_packing(spark):
    rows, lib = corpus(), library(BYTE)
    got = pack(clashing(docs(spark, rows))).collect()
    bins, found = {}, []
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        found.append((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= 1024
    want = []
    for i, t, _ in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids), 1024), len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert len(bins) <= -(-sum(w[3] for w in want) // 1024) + 1
    assert pack(docs(spark, [])).count() == 0


def test_digests_of_the_query(spark, tmp_path):
    from upland.llm.queries import QUERIES

    rows = corpus(long_words=200)
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    lib = library(BYTE)
    want = []
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op9_bpe"](spark, str(tmp_path)).collect()), key=repr) == sorted(want, key=repr)


def test_rules_of_production_go_on_until_no_pair_is_frequent():
    from upland.llm.repair import LEAST, compress

    passage = np.arange(64, dtype=np.uint16)
    now, _, rules = compress(np.tile(np.append(passage, 100), 40).astype(np.uint16), np.arange(64, 40 * 65, 65), 200)
    lengths = np.ones(200 + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[200 + k] = lengths[a] + lengths[b]
    assert LEAST == 4 and lengths.max() >= 64 and len(now) == 40 and lengths[now].sum() == 40 * 65


def test_a_task_without_encoder_lets_it_go():
    """Placing pieces begins at once after encoding, before an idle worker would drop its encoder."""
    with T.kept(("any",), object) as held:
        T.let_go()
        assert T._KEPT.value is held  # not while it is lent
    T.let_go()
    assert T._KEPT.value is None and T._KEPT.key is None
    with T.kept(("any",), list) as held:
        assert held == []


def test_a_word_with_signs_is_put_together_from_two():
    """The library gets letters and signs once each, however they are joined or written."""
    seen, run = [], T.library_encoder(WORD, "word")
    encoder = PieceEncoder(WORD, lambda pieces: (seen.extend(pieces), run(pieces))[1])
    texts = ["Été hello &&& hello&&&  été!!", "\thello,*** ÉTÉ Hello'' ", "", "İ! É<|startoftext|> <|x"]
    got = [x.tolist() for x in encoder.texts([t.encode() for t in texts] + [None])]
    assert got == [library(WORD).encode(t, add_special_tokens=False).ids for t in [*texts, ""]]
    assert sorted(seen) == sorted(["!!", "&&&", ",***", "''", "hello", "été", "İ!", "É<|startoftext|>", "<|x"])
