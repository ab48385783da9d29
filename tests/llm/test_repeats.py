import hashlib

import numpy as np
import pytest
from helpers import clashing, corpus, docs, words

import upland.llm.repeats as R
from upland.llm.suffix_array import repeated_passages, without_repeats
from upland.llm.suffix_tree import build, without_repeated_windows


def removed(rows):
    """Which words of each row lie in a window of 50 that also starts in a document with a smaller id."""
    least = {}
    for i, t, _ in rows:
        w = words(t)
        if i is not None:
            for p in range(len(w) - 49):
                key = tuple(w[p : p + 50])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, t, _ in rows:
        w = words(t)
        gone = [False] * len(w)
        if i is not None:
            for p in range(len(w) - 49):
                if least[tuple(w[p : p + 50])] < i:
                    gone[p : p + 50] = [True] * 50
        out.append((i, w, gone))
    return out


def want_rows(rows):
    out = []
    for i, w, gone in removed(rows):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_subtree_nodes():
    words = np.array([1, 2, 3, 9, 1, 2, 4, 9, 1, 2, 3, 9, 7, 7, 7, 7])
    at, doc = np.array([0, 4, 8, 12]), np.array([5, 6, 7, 8])
    tree = build(words, at, np.zeros(4, np.int64), doc, 4)
    found = {(int(d), tuple(sorted(at[tree.order[a:b]].tolist())), int(low)) for d, a, b, low in zip(tree.depth, tree.first, tree.last, tree.least, strict=True)}
    # the root, the common beginning 1 2, and the whole suffix that two documents share
    assert found == {(0, (0, 4, 8, 12), 5), (2, (0, 4, 8), 5), (4, (0, 8), 5)}
    assert all(tree.depth[p] < d for p, d in zip(tree.parent, tree.depth, strict=True) if p >= 0)


@pytest.mark.parametrize("limit", [500, 1, 3])
def test_tree_matches_brute_force(spark, monkeypatch, limit):
    """With small limits, windows are dealt by growing prefixes."""
    monkeypatch.setattr(R, "GROUP", limit)
    rows = corpus(long_words=3000)
    got = without_repeated_windows(clashing(docs(spark, rows)))
    assert sorted(map(tuple, got.collect()), key=repr) == want_rows(rows)


def test_common_passage_with_many_surroundings(spark, monkeypatch):
    """Groups that stay large up to the prefix of a whole window."""
    monkeypatch.setattr(R, "GROUP", 4)
    passage = " ".join(f"p{k}" for k in range(90))
    rows = [(i, f"{' '.join(f'a{i}x{k}' for k in range(60))} {passage} {' '.join(f'b{i % 3}x{k}' for k in range(60))}", "s") for i in range(12)]
    got = without_repeated_windows(docs(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == want_rows(rows)


def test_large_group_of_near_copies_makes_no_row_per_window(spark, monkeypatch):
    """700 different surroundings of one passage fit a task; their windows aren't dealt one by one."""
    asked, read = [], R._read
    monkeypatch.setattr(R, "_read", lambda docs, wanted, rows_of, shape: (asked.append(rows_of), read(docs, wanted, rows_of, shape))[1])
    passage = " ".join(f"p{k}" for k in range(52))
    rows = [(i, f"{' '.join(f'a{i}x{k}' for k in range(40))} {passage} {' '.join(f'b{i}x{k}' for k in range(40))}", "s") for i in range(700)]
    got = without_repeated_windows(docs(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == want_rows(rows)
    assert asked == [R._worded]


@pytest.mark.parametrize("limit", [500, 2])
def test_array_spans_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "CHUNK", 5)
    monkeypatch.setattr(R, "GROUP", limit)
    rows = corpus(long_words=3000)
    got = {}
    for r in repeated_passages(clashing(docs(spark, rows))).collect():
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.stop_word))
        assert r.first_doc_id < r.doc_id and r.n_words == r.stop_word - r.start_word >= 50
    want = {}
    for i, _, gone in removed(rows):
        if any(gone):
            want.setdefault(i, set()).update(k for k, g in enumerate(gone) if g)
    assert got == want


def test_long_text_repeated_and_short(spark):
    body = " ".join(f"v{k}" for k in range(20_000))
    rows = [(5, body, "s"), (6, "pre " + body + " post", "s"), (7, body + " " + body, "s"), (7, "tiny", "s"), (8, " ".join(body.split()[:50]), "s"), (9, " ".join(body.split()[:49]), "s")]
    got = without_repeated_windows(docs(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == want_rows(rows)


def test_pipeline_form(spark):
    rows = [r for r in corpus(long_words=1000)]
    d = clashing(docs(spark, rows))
    got = without_repeats(d)
    assert got.columns == d.columns
    want = []
    for (_, text, _), (i, w, gone) in zip(rows, removed(rows), strict=True):
        if not any(gone):
            want.append((i, text))
        elif not all(gone):
            want.append((i, " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    changed = {i for i, _, g in removed(rows) if any(g)}
    norm = lambda i, t: (i, " ".join(words(t)) if i in changed else t)
    assert sorted((norm(r.doc_id, r.text) for r in got.collect()), key=repr) == sorted((norm(*x) for x in want), key=repr)
    assert all(r.n_chars is None or r.n_chars == len(r.text or "") for r in got.collect())


def test_empty(spark):
    for rows in ([], [(1, None, None), (2, "", "s"), (None, "a", "s")]):
        assert repeated_passages(docs(spark, rows)).count() == 0
        assert without_repeated_windows(docs(spark, rows)).count() == len(rows) and without_repeats(docs(spark, rows)).count() == len(rows)
