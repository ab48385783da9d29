import random

import numpy as np
import pytest
from helpers import clashing, corpus, docs, sentence, words

import upland.llm.minhash as M


def shingle_set(text):
    w = words(text, lower=True)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def plain(rows, percent):
    sets = {}
    for i, t, _ in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingle_set(t))
    ids = list(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return sorted(((i, len(shingle_set(t)), find(i), find(i) == i) for i, t, _ in rows if i is not None), key=repr)


@pytest.mark.parametrize("percent", [80, 85])
def test_components_match_brute_force(spark, percent):
    rows = corpus(long_words=3000)
    got = M.near_duplicates(clashing(docs(spark, rows)), percent).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, percent)


def test_chains_near_the_threshold_in_blocks(spark, monkeypatch):
    """A long chain of copies, each a little off the one before, over many small blocks."""
    rng = random.Random(5)
    w = sentence(rng, 160, 10_000).split()
    rows = []
    for i in range(60):
        rows.append((i * 3 % 61, " ".join(w), "s"))
        for _ in range(2):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
    monkeypatch.setattr(M, "GROUP_SHINGLES", 1500)
    monkeypatch.setattr(M, "CROWD", 2)
    monkeypatch.setattr(M, "DEALT", 3)
    got = M.near_duplicates(docs(spark, rows), 85).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 85)


def test_estimate_is_close():
    rng = np.random.default_rng(3)
    every = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.sort(every[:2500]), np.sort(every[500:])
    regs = M.registers([a, b, np.sort(every[:3]), np.empty(0, np.uint64)], 308)
    agree = (regs[0] == regs[1]).mean()
    chance = M._collisions(np.array([2500]), 2500, 308)[0]
    assert abs((agree - chance) / (1 - chance) - 2000 / 3000) < 0.15 and len(set(regs[2].tolist())) <= 3


def test_pipeline_form_keeps_rows(spark):
    rows = corpus(long_words=500)
    d = clashing(docs(spark, rows))
    got = M.one_of_each(d, 80)
    kept = {i for i, _, _, k in plain(rows, 80) if k}
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(kept) and ids.count(None) == 2 and got.columns == d.columns


def test_pipeline_form_keeps_other_texts_of_a_doc_id(spark):
    rng = random.Random(8)
    a, b, c, d = (sentence(rng, 80) for _ in range(4))
    rows = [(1, a, "s"), (2, a, "s"), (2, b, "s"), (2, b, "s"), (2, None, "s"), (3, c, "s"), (3, d, "s"), (3, c + " x", "s"), (4, d, "s"), (5, b, "s")]
    got = [(r.doc_id, r.text) for r in M.one_of_each(clashing(docs(spark, rows)), 80).collect()]
    texts = [t.removesuffix(" x") for _, t in got if t]
    assert sorted(texts) == sorted([a, b, c, d]) and (1, a) in got and got.count((2, None)) == 1 and len(got) == 5


def test_empty(spark):
    assert M.near_duplicates(docs(spark, [])).count() == 0 and M.one_of_each(docs(spark, [])).count() == 0
    assert M.near_duplicates(docs(spark, [(1, None, None), (2, "", "s"), (3, " ", "s")])).where("kept").count() == 3
