"""The queries opN_<name>: each applies its operator to its whole table; oracle SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import search
from .bpe import encode_decode
from .chat import format_chats
from .common import table
from .licences import COPYRIGHT, KNOWN, MARKS, SPELLINGS, licence_scan
from .minhash import near_duplicates
from .packing import pack
from .quality import quality_rules
from .repair import read_shards, write_shards
from .suffix_array import repeated_passages
from .suffix_tree import without_repeated_windows


def op1_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op2_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(spark, write_shards(table(spark, sf_dir, "documents")))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op4_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op6_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_windows(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_decode(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_snapshots": op1_chat_snapshots,
    "op2_repair_ids": op2_repair_ids,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_licence_digests": op4_licence_digests,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_multi_index_hashing": op6_multi_index_hashing,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_bpe": op9_bpe,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
}

OP1_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS l, count(*) AS n FROM t GROUP BY conv_id),
one AS (SELECT l, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY l, n),
kept AS (SELECT * FROM one a WHERE NOT EXISTS (SELECT 1 FROM one b WHERE b.n > a.n AND b.l[1] = a.l[1] AND list_slice(b.l, 1, a.n) = a.l))
SELECT conv_id, any_value(n)::BIGINT AS n_turns, any_value(n_copies)::BIGINT AS n_copies,
  string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text
FROM kept JOIN t USING (conv_id) GROUP BY conv_id
"""


def _canonical_sql(text: str) -> str:
    marks = MARKS.replace(r"\x{00A0}", "\u00a0")
    out = f"regexp_replace(regexp_replace(lower({text}), '{COPYRIGHT}', chr(10), 'g'), '{marks}', ' ', 'g')"
    for a, b in SPELLINGS:
        out = f"replace({out}, '{a}', '{b}')"
    return f"trim({out})"


_KNOWN_SQL = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
OP4_SQL = f"""
WITH known AS (SELECT sha256({_canonical_sql("text")}) AS digest, min(licence) AS licence FROM (VALUES {_KNOWN_SQL}) AS k(licence, text) GROUP BY 1),
unit AS (
  SELECT doc_id, 'document' AS scope, NULL::INTEGER AS line, text FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, 'line', (i - 1)::INTEGER, l[i] FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)))
SELECT doc_id, scope, line, licence, digest FROM (SELECT doc_id, scope, line, sha256({_canonical_sql("text")}) AS digest FROM unit) JOIN known USING (digest)
"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM pos),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM tri, (VALUES (0), (1), (2)) AS t(o) WHERE c > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM b WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT sum(f)::DOUBLE / sum(n) AS mean, sum(n * (f::DOUBLE / n) * (f::DOUBLE / n)) / sum(n) - (sum(f)::DOUBLE / sum(n)) * (sum(f)::DOUBLE / sum(n)) AS var FROM h),
p AS (SELECT mean, CASE WHEN var > 0 AND mean * (1 - mean) / var - 1 > 0 THEN mean * (1 - mean) / var - 1 ELSE 1.0 END AS weight FROM m),
q AS (SELECT source, n, mean, weight, (f + mean * weight) / (n + weight) AS rate FROM h, p),
v AS (SELECT source, rate - 2 * sqrt(rate * (1 - rate) / (n + weight + 1)) > 4 * mean / (1 + 3 * mean) AS rejected FROM q)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM b LEFT JOIN v USING (source)
"""

REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
least AS (SELECT g, min(doc_id) AS low FROM win GROUP BY g),
hit AS (SELECT doc_id, i, low FROM win JOIN least USING (g) WHERE low < doc_id),
island AS (SELECT doc_id, i, low, sum(CASE WHEN i - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM (SELECT doc_id, i, low, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit)),
span AS (SELECT doc_id, min(i) - 1 AS start_word, max(i) + 49 AS stop_word, min(low) AS first_doc_id FROM island GROUP BY doc_id, k)
"""
OP3_SQL = REPEATS_SQL + "SELECT doc_id, start_word::BIGINT AS start_word, stop_word::BIGINT AS stop_word, (stop_word - start_word)::BIGINT AS n_words, first_doc_id FROM span"
OP8_SQL = REPEATS_SQL + r"""
, gone AS (SELECT doc_id, unnest(range(start_word + 1, stop_word + 1)) AS i FROM span),
word AS (SELECT doc_id, w[i] AS x, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_snapshots": OP1_SQL,
    "op3_suffix_array_dedup": OP3_SQL,
    "op4_licence_digests": OP4_SQL,
    "op7_quality_rules": OP7_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op10_minhash_near_dedup": OP10_SQL,
}
