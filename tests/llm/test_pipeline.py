import zlib

import numpy as np
import pytest
from helpers import clashing, corpus, docs, words
from test_minhash import plain as components_of
from test_quality import plain as counts_of
from test_repeats import removed

pipeline = pytest.importorskip("corpus_pipeline")


def test_run_matches_brute_force(spark, tmp_path):
    from upland.llm.tokens import library, vocabulary

    rows = [r for r in corpus(long_words=800) if r[0] is not None]
    rows = list(dict.fromkeys(rows))
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = pipeline.run(spark, str(tmp_path)).collect()

    good = [r for r in rows if (c := counts_of(r[1]))[0] >= 50 and 100 * c[4] <= 50 * c[0]]
    kept = {i for i, _, _, k in components_of(good, 80) if k}
    good = [r for r in good if r[0] in kept]
    lib, want = library(vocabulary("byte_bpe_50k.json")), {}
    for (i, text, _), (_, w, gone) in zip(good, removed(good), strict=True):
        if not any(gone):
            want[i] = text
        elif not all(gone):
            want[i] = None, [x for x, g in zip(w, gone, strict=True) if not g]
    assert {r.doc_id for r in got} == set(want)
    for i, text in want.items():
        if isinstance(text, str):
            ids = np.array(lib.encode(text, add_special_tokens=False).ids + [2], "<u4")
            mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i)
            assert sum(m[2] for m in mine) == len(ids) and all(zlib.crc32(ids[s : s + n].tobytes()) == c for _, s, n, c in mine)


@pytest.mark.parametrize("k", range(4))
def test_stages_take_anything(spark, k):
    name, stage = pipeline.STAGES[k]
    for frame in (docs(spark, []), clashing(docs(spark, corpus(long_words=300)))):
        out = stage(spark, frame, "")
        out.count()
        if k < 3:
            assert out.columns == frame.columns and out.dtypes == frame.dtypes
    kept = stage(spark, docs(spark, [(1, " ".join(f"w{i}" for i in range(80)), "s")]), "")
    assert kept.count() == 1 and words(kept.first()[1] if k < 3 else "") is not None
