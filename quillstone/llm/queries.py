"""The registered queries of this folder and their DuckDB equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe_tree, exact_dedup, hmm_lm, html_crf, near_dedup, packing, quality, secrets, substring_dedup, token_counts
from .common import table

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_MODEL = "word_bpe_49k.json"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.encode_documents(_docs(spark, sf_dir), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_docs(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_docs(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir), public_tokenizers.path(WORD_MODEL))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_docs(spark, sf_dir))


def op7_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score_documents(_docs(spark, sf_dir))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_docs(spark, sf_dir), public_tokenizers.path(WORD_MODEL))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(_docs(spark, sf_dir), size=2)


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op2 that SQL can say."""
    return op2_quality(spark, sf_dir).drop("kept", "score")


def secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op4 that SQL can say."""
    return op4_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


QUERIES = {f.__name__: f for f in (op1_bpe, op2_quality, op3_substring_dedup, op4_secrets, op5_packing, op6_exact_dedup, op7_hmm, op8_html, op9_token_counts, op10_near_dedup, quality_base, secrets_base)}

QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT rid, p, count(*) OVER (PARTITION BY rid, body) AS n
  FROM (SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS body FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM d))
), covered AS (
  SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS pos FROM grams WHERE n > 1) GROUP BY rid
), counted AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
"""

_ASSIGN = secrets.ASSIGN.replace("'", "''")
_KINDS = ((_ASSIGN, f"length(regexp_extract(hit, '^{_ASSIGN}$', 2)) >= 12"), ("AKIA[A-Z0-9]+", "length(hit) >= 18"), ("[0-9a-f]+", "length(hit) >= 16"))
# Matches and the pieces between them add up to positions.
SECRETS_SQL = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents
), found AS (
  {" UNION ALL ".join(f"SELECT rid, {k} AS kind, regexp_extract_all(t, '{p}') AS h, string_split_regex(t, '{p}') AS g FROM d" for k, (p, _) in enumerate(_KINDS))}
), each AS (
  SELECT rid, kind, unnest(h) AS hit, unnest(g[1:len(h)]) AS gap, unnest(range(len(h))) AS i FROM found
), placed AS (
  SELECT rid, kind, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM each
), kept AS (
  SELECT rid, kind, stop - length(hit) AS start, stop FROM placed WHERE {" OR ".join(f"kind = {k} AND {c}" for k, (_, c) in enumerate(_KINDS))}
), spans AS (
  SELECT rid, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b, count(*) FILTER (WHERE kind = 2) AS c,
    string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY start, kind) AS joined FROM kept GROUP BY rid
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(joined, '')) AS base_sha256 FROM d LEFT JOIN spans USING (rid)
"""

OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), g AS (
  SELECT doc_id, body,
         first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place, count(*) OVER (PARTITION BY body) AS group_size
  FROM d WINDOW w AS (PARTITION BY body ORDER BY n DESC, doc_id NULLS LAST, rid)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM g
"""

# A window is held as its words joined by one space, which no word contains.
OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS MATERIALIZED (
  SELECT doc_id, rid, p, array_to_string(w[p:p + 12], ' ') AS body FROM (SELECT doc_id, rid, w, unnest(range(1, len(w) - 11)) AS p FROM d)
), owner AS (
  SELECT body, min(doc_id) AS least FROM win GROUP BY body
), gone AS (
  SELECT DISTINCT rid, unnest(range(p, p + 13)) AS pos FROM win JOIN owner USING (body) WHERE least < doc_id
), word AS (
  SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d
), left_over AS (
  SELECT word.rid, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY word.pos) FILTER (WHERE gone.pos IS NULL) AS kept
  FROM word LEFT JOIN gone USING (rid, pos) GROUP BY word.rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (rid)
"""

# Links by an equality join on shingles, then everything that links lead to.
OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS grams FROM d
), g AS MATERIALIZED (
  SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s
), link AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM g AS a JOIN g AS b ON a.gram = b.gram AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS root FROM s UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON reach.root = link.x
), least AS (
  SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN least USING (doc_id)
"""

ORACLES = {"quality_base": QUALITY_SQL, "secrets_base": SECRETS_SQL, "op3_substring_dedup": OP3_SQL, "op6_exact_dedup": OP6_SQL, "op10_near_dedup": OP10_SQL}
