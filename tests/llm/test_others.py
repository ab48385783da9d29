import json

import numpy as np
import pytest
from helpers import clashing, docs
from pyspark.sql import functions as F

import upland.llm.ann as A
import upland.llm.chat as C
from upland.llm import common
from upland.llm.common import components
from upland.llm.licences import _MIT, KNOWN, licence_scan

CONV = "conv_id long, turn long, role string, text string"


def chat_plain(rows):
    conv = {}
    for c, turn, role, text in rows:
        if c is not None:
            conv.setdefault(c, set()).add((turn is not None, turn if turn is not None else 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in conv.items()}
    out = []
    for c, own in turns.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in turns.values())
        same = [x for x, o in turns.items() if o == own]
        if not longer and c == min(same):
            out.append((c, len(own), len(same), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in own)))
    return sorted(out)


def test_snapshots_collapse(spark, monkeypatch):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", None)]
    rows = []
    for c, n in ((1, 1), (2, 2), (3, 4), (4, 3), (5, 4)):
        rows += [(c, 10 + k, r, t) for k, (r, t) in enumerate(talk[:n])]
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "other"), (7, None, None, None), (8, 0, "user", "x"), (8, 0, "user", "x"), (None, 0, "user", "hi")]
    rows += [(9, k, "user", f"t{k}") for k in range(40)] + [(10, k, "user", f"t{k}") for k in range(39)] + [(11, 0, "user", "hi"), (11, 0, "assistant", "tie")]
    rows += [(12, 5, r, t) for r, t in [("user", "b"), ("user", "a"), ("assistant", "c"), ("user", "d")]] + [(13, 5, "user", f"{k % 7} tie {k}") for k in range(30)] + [(13, 6, "user", "end")]
    rows += [(14, *x[1:]) for x in rows if x[0] == 13 and x[1] == 5]
    frame = spark.createDataFrame(rows, CONV)
    for segment, crowded in ((1024, 4096), (7, 4)):
        monkeypatch.setattr(C, "SEGMENT", segment)
        monkeypatch.setattr(C, "CROWDED", crowded)
        got = C.format_chats(clashing(frame)).collect()
        assert sorted(map(tuple, got)) == chat_plain(rows)
    assert 14 not in {r.conv_id for r in got}
    assert C.format_chats(spark.createDataFrame([], CONV)).count() == 0


def test_licences(spark):
    british = _MIT.replace("sublicense", "sub-licence").upper()
    rows = [(1, _MIT, "s"), (2, f"The MIT License (MIT)\n\nCopyright (c) 2020  A. Person\n\n{_MIT}", "s"), (3, british, "s"), (4, _MIT[:-30], "s"), (5, "text\n  Licensed under the APACHE licence, version 2.0\nmore", "s"), (6, None, None), (7, "", "s"), (8, "...", "s"), (None, "Released under the MIT License.", "s"), (9, "Released under the MIT License!\nReleased under the MIT License.", "s")]
    got = sorted(((r.doc_id, r.scope, r.line, r.licence) for r in licence_scan(clashing(docs(spark, rows))).collect()), key=repr)
    assert got == sorted([(1, "document", None, "MIT"), (2, "document", None, "MIT"), (3, "document", None, "MIT"), (5, "line", 1, "Apache-2.0"), (None, "document", None, "MIT"), (None, "line", 0, "MIT"), (9, "line", 0, "MIT"), (9, "line", 1, "MIT")], key=repr)
    assert licence_scan(docs(spark, [])).count() == 0


def test_licences_in_usual_wrappings(spark):
    import textwrap

    whole = [(name, text) for name, text in KNOWN if len(text) > 200]
    rows, want = [], []
    for name, text in whole:
        for width in range(30, 101):
            wrapped = "\n".join(textwrap.fill(p, width, break_long_words=False) for p in text.split("\n"))
            for mark in ("", "# ", " * ", "// "):
                rows.append((len(rows), "".join(f"{mark}{x}\n" for x in ["Copyright (c) 2020 A. Person", "Copyright Joyent, Inc. and others", "(c) 2019 B", "All rights reserved.", "", *wrapped.split("\n")]), "s"))
                want.append((rows[-1][0], name))
    got = sorted((r.doc_id, r.licence) for r in licence_scan(docs(spark, rows)).where("scope = 'document'").collect())
    assert got == want


def test_licences_of_the_whole_table(spark):
    from upland.llm.licences import all_known

    bsd = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
    want = {1: {"BSD-3-Clause"}, 2: {"BSD-3-Clause"}, 3: {"ISC"}, 4: {"BSD-3-Clause"}, 5: {"AGPL-3.0-only"}, 6: {"MPL-2.0"}, 7: {"CC-BY-NC-SA-4.0"}}
    texts = [bsd, "BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + bsd, "ISC License\n\nCopyright 2020 A\n\n" + dict(KNOWN)["ISC"]]
    texts += ["x = 1\n# SPDX-License-Identifier: BSD-3-Clause", "/* SPDX-License-Identifier: AGPL-3.0-only */\nint x;", "Licensed under MPL 2.0.", "Released under CC BY-NC-SA 4.0."]
    rows = [(k, t, "s") for k, t in enumerate(texts, 1)]
    for name, text in all_known():
        rows.append((len(rows) + 1, text, "s"))
        want[len(rows)] = {name}
    got = {}
    for r in licence_scan(docs(spark, rows)).collect():
        got.setdefault(r.doc_id, set()).add(r.licence)
    same = {"GPL-3.0-only": "GPL-3.0"}
    assert {k: {same.get(n, n) for n in v} for k, v in want.items()} == {k: {same.get(n, n) for n in v} for k, v in got.items()}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "Unlicense", "CC0-1.0", "CC-BY-SA-4.0"} <= {n for n, t in all_known() if len(t) > 1000}


def vectors(spark, items):
    return spark.createDataFrame(items, "vec_id long, embedding array<float>, label int")


def test_search_recall_and_cases(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 32)).astype(np.float32)
    x[7] = x[3]
    x[20] = x[3]
    x[100:110] *= 3  # lengths differ
    items = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    items += [(2000, None, 0), (2020, [0.0] * 32, 0), (2040, [float("nan")] + [1.0] * 31, 0), (2060, [None] + [1.0] * 31, 0), (2080, [1.0, 2.0], 0), (None, x[0].tolist(), 0), (2100, [float("inf")] * 32, 0)]
    monkeypatch.setattr(A, "BLOCK", 400)
    got = {}
    for r in A.search(clashing(vectors(spark, items))).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 20))
    d, hit = x.astype(np.float64), 0
    for q, found in got.items():
        score = d @ d[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(d)), -score))[:20]
        hit += len(set(best.tolist()) & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == list(range(1, 21)) and found == sorted(found, key=lambda f: (-f[2], f[1]))
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in found)
    assert hit >= 0.9 * 20 * len(got)
    assert [v for _, v, _ in got[20]][:2] == [3, 7]  # ties: the smaller id first


def test_search_repeated_ids_and_common_vectors(spark, monkeypatch):
    """Rows that share an id count once; a vector that most rows hold is searched like others."""
    monkeypatch.setattr(A, "BLOCK", 16)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 8)).astype(np.float32)
    items = [(k, x[0 if k % 3 else k % 40].tolist(), 0) for k in range(200)] * 2 + [(20, (x[0] + 9).tolist(), 0)]
    d = {}
    for k, v, _ in items:
        d[k] = min(d.get(k, v), v)
    ids = np.array(sorted(d))
    v = np.array([d[k] for k in ids], np.float64)
    got = {}
    for r in A.search(vectors(spark, items)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(range(0, 200, 20))
    hit = 0
    for q, found in got.items():
        score = (v * v[ids == q]).sum(axis=1)
        best = [(int(ids[i]), float(score[i])) for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        assert len({i for i, _ in found}) == 20 and all(i != q for i, _ in found)
        hit += len(set(best) & set(found))
    assert hit >= 0.9 * 20 * len(got)


def test_buckets_hold_all_codes_within_the_radius():
    rng = np.random.default_rng(3)
    codes = A.Codes(rng.standard_normal((300, 16)), 9.0, 5, 300)
    own = rng.integers(0, 1 << codes.width, (400, codes.tables)).astype(np.uint32)
    low = codes.width - 2
    for radius in (0, 7, 30, codes.whole):
        reach, code, found = codes.reach(radius), own[5] ^ np.uint32(1), []
        for t in range(codes.tables):
            for start in range(4):
                part = np.flatnonzero(own[:, t] >> low == start)
                found += part[A.Buckets(own[part], t, low).within(code, start, reach)].tolist()
        apart = np.bitwise_count(own ^ code)
        assert len(found) == len(set(found)) and set(found) == set(np.flatnonzero((apart <= reach).any(axis=1)).tolist())
        assert set(np.flatnonzero(apart.sum(axis=1) <= radius).tolist()) <= set(found)


def test_search_small_tables(spark):
    assert A.search(vectors(spark, [])).count() == 0
    assert A.search(vectors(spark, [(0, None, 0)])).count() == 0
    got = A.search(vectors(spark, [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [-1.0, 0.0], 0)])).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]


@pytest.mark.parametrize("few", [100, 0])
def test_components_of_few_edges_start_few_jobs(spark, monkeypatch, few):
    """Both ways give the same labels; few edges take no more jobs for a long chain."""
    monkeypatch.setattr(common, "FEW_EDGES", few)
    rng = np.random.default_rng(7)
    chain = rng.permutation(60).tolist()
    edges = [*zip(chain, chain[1:], strict=False), (100, 101), (101, 100), (102, 102), (103, 101)]
    spark.sparkContext.setJobGroup("components", "")
    got = components(spark.createDataFrame(edges, "a long, b long"))
    started = len(spark.sparkContext.statusTracker().getJobIdsForGroup("components"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.node: r.label for r in got.collect()} == {i: 0 for i in range(60)} | {100: 100, 101: 100, 103: 100}
    assert started <= 6 if few else started > 6


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (103, 101), (200, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100, 103: 100}


def test_entry_imports_without_these_operators(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/upland", tmp_path / "upland", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e, json; print(json.dumps([len(e.queries()), sorted(e.oracle_sql())]))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    n, names = json.loads(out.stdout.splitlines()[-1])
    assert n > 50 and not [x for x in names if x.startswith("op") and x[2].isdigit()]


def test_frames_keep_no_python_on_native_paths(spark):
    from upland.llm.quality import text_counts

    d = docs(spark, [(1, "a b c", "s")])
    for frame in (text_counts(d), licence_scan(d)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert d.select(F.lit(1)).count() == 1
