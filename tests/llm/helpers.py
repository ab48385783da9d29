"""Small corpora with the awkward cases, and plain versions of what the operators compute."""

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside; inputs may have them too.
CLASHES = ("host", "row", "spans", "digest", "bands", "tag", "anchor", "component_id", "kept", "n_words", "piece", "start", "length", "sequence_id", "ids", "label", "node", "group", "plain", "licence", "line", "scope", "image", "part", "shard", "bad_host", "nth", "w", "k", "block", "turns")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


def clashing(frame):
    return frame.withColumns({c: F.lit("x") for c in CLASHES if c not in frame.columns})


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1, long_words=30_000):
    """(doc_id, text, source): near and exact copies, shared passages, empty, null, long and odd texts."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randrange(60, 200)) for _ in range(12)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    for i in range(12, 24):  # near copies
        words = base[i % 6].split()
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "s0"))
    passage = sentence(rng, 70)
    rows += [(i, f"{sentence(rng, 40)}\n{passage}\n{sentence(rng, 30)}", "s1") for i in range(24, 30)]
    rows += [(30, None, None), (31, "", "s0"), (32, " \t\n ", "s0"), (33, "one two", "s1"), (34, "One TWO", "s1"), (35, "x " * 49 + "x", "s2"), (36, "Ünï cödé 🙂 İ ǅ  a b  c\n\n d", "s2")]
    rows += [(37, base[0], "s0"), (37, base[0], "s0"), (None, base[1], "s0"), (None, None, None)]
    rows += [(38, sentence(rng, long_words, 5000) + " " + base[2], "s2"), (39, "<|endoftext|> 's a<|startoftext|>b", "s2"), (40, "same line\nsame line\nother\nsame line\n \n \n", "s1")]
    return rows


def words(text, lower=False):
    if lower:
        text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return WORD.findall(text or "")


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
