"""Quality rules with host verdicts, in DataFrame functions only.

Every document gets its counts in one pass over its row, with no shuffle of text. The failures of
the base rules are summed by host, a host's failure rate is shrunk towards the corpus by a beta
prior fitted to all hosts (method of moments), and the verdict goes back to the documents. A host is
rejected if its odds to fail are surely over ODDS times those of the corpus: its shrunk rate, less
SURE standard deviations of its posterior, exceeds the rate with those odds. So a host that fails
as others do, or has few documents, keeps its clean documents, whatever the corpus' rate is.

Defined cases: a null or empty text has no words and fails; a document without a host gets no host
verdict; repeated rows are judged one by one; a very long text is counted whole; a host on the limit is
not rejected; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, materialize

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: What makes a host's verdict (see above).
ODDS, SURE = 4.0, 2.0
#: So many hosts at most are broadcast (some 10 MB); beyond it, hosts are joined by shuffling, a host's rows in SALTS parts.
BROADCAST_HOSTS, SALTS = 100_000, 64
SYMBOLS = "#*$%&|<>"


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that the text holds twice or more."""

    def marked(s: Column) -> Column:
        hit = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | (F.get(s, i + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(hit, lambda x: x["p"]))

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.array_sort(F.transform(at, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))))

    def covered(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(let(windows(words), marked), covered)).cast("long")


def _line_repeats(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def text_counts(docs: DataFrame, *names: str) -> DataFrame:
    """doc_id, host, the counts of every document and the columns named."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = let(
        F.filter(F.split(text, f"{SPACE}+", -1), lambda x: x != ""),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeat_words(w).alias("n_repeat_words")),
    )
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    counts = docs.select(*names, "doc_id", F.col("source").alias("host"), found.alias("w"), symbols.cast("long").alias("n_symbols"), _line_repeats(text).alias("n_dup_lines"))
    return counts.select(*names, "doc_id", "host", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    )


def host_verdicts(counts: DataFrame) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, rejected: one row per host.

    The prior is a beta distribution with the mean and variance of the hosts' rates, weighted by
    documents; where the variance fits no beta distribution, its weight is that of one document.
    """
    hosts = counts.where("host is not null").groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    whole = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.sum(F.col("n_docs") * rate * rate).alias("sq"))
    mean = F.col("f") / F.col("n")
    prior = whole.select(mean.alias("mean"), F.greatest(F.col("sq") / F.col("n") - mean * mean, F.lit(0.0)).alias("var"))
    fit = F.try_divide(F.col("mean") * (1 - F.col("mean")), F.col("var")) - 1
    prior = prior.select("mean", F.when(fit > 0, fit).otherwise(F.lit(1.0)).alias("weight"))
    # one row of totals: it is broadcast whatever the size of the corpus
    shrunk = (F.col("n_failed") + F.col("mean") * F.col("weight")) / (F.col("n_docs") + F.col("weight"))
    found = hosts.join(F.broadcast(prior)).withColumn("shrunk_rate", shrunk)
    rate = F.col("shrunk_rate")
    spread = F.sqrt(rate * (1 - rate) / (F.col("n_docs") + F.col("weight") + 1))
    limit = ODDS * F.col("mean") / (1 + (ODDS - 1) * F.col("mean"))
    return found.withColumn("rejected", rate - SURE * spread > limit).select("host", "n_docs", "n_failed", "shrunk_rate", "rejected")


def _with_hosts(rows: DataFrame, hosts: DataFrame, how: str) -> DataFrame:
    """rows (host, ..) joined with hosts (host, ..), none of which need meet in one task."""
    hosts = materialize(hosts)
    if hosts.count() <= BROADCAST_HOSTS:
        return rows.join(F.broadcast(hosts), "host", how)
    salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], how).drop("salt")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, base_failed, the host's shrunk rate and kept, for every document."""
    counts = materialize(text_counts(docs))
    found = _with_hosts(counts, host_verdicts(counts).select("host", "shrunk_rate", "rejected"), "left")
    kept = ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "host", "shrunk_rate")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of docs, unchanged, that the rules keep.

    The counts are worked out once: a table holds each document's host and whether it failed, and the rows of
    those that didn't. The hosts' rates are read from its narrow columns, then the rows by the hosts' verdicts.
    """
    counts = text_counts(docs.select("doc_id", "text", "source", F.struct("*").alias("row")), "row")
    judged = materialize(counts.select("doc_id", "host", "base_failed", F.when(~F.col("base_failed"), F.col("row")).alias("row")))
    bad = host_verdicts(judged.select("host", "base_failed")).where("rejected").select("host")
    return _with_hosts(judged.where("NOT base_failed"), bad, "left_anti").select("row.*")
