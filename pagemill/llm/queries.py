"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, exact_dedup, html_text, langid, licenses, near_dedup, packing, sharding, token_files
from .common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=8)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_documents(token_files.write_token_files(table(spark, sf_dir, "documents")))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_exact_dedup, op2_sharding, op3_decontamination, op4_html_extraction, op5_language_id, op6_license_scan, op7_chat_formatting, op8_token_files, op9_minhash_near_dedup, op10_packing)
    return {f.__name__: f for f in named}


ORACLE: dict[str, str] = {}

ORACLE["op1_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS c FROM documents
), r AS (
  SELECT doc_id, c, first_value(doc_id) OVER (PARTITION BY c ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY c) AS group_size FROM n
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(c) AS text_sha256 FROM r
"""


def license_sql() -> str:
    """DuckDB SQL of the licence scan, from the same phrases and templates."""
    word = r"[0-9a-z\x{80}-\x{10FFFF}]+"
    lower = f"translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    phrases = ", ".join(f"({quoted(p.split())}, '{label}')" for p, label in licenses.PHRASES.items())
    whole = {label: licenses.words_of(t) for label, t in licenses.TEMPLATES.items()}
    templates = ", ".join(f"('{label}', {quoted(sorted(set(words)))}, {licenses.block_words(len(words))})" for label, words in whole.items())
    return f"""
WITH w AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all({lower}, '{word}') AS words FROM documents),
p(phrase, label) AS (VALUES {phrases}),
places AS (SELECT n, label, unnest(list_filter(list_transform(range(len(words)), lambda i: CASE WHEN words[i + 1 : i + len(phrase)] = phrase THEN i END), lambda i: i IS NOT NULL)) AS start FROM w, p),
b AS (SELECT n, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY n),
t(label, words, wide) AS (VALUES {templates}),
l AS (SELECT n, wide, list_distinct(words[s0 + 1 : s0 + 2 * wide]) AS words FROM (SELECT n, words, wide, unnest(range(0, len(words), wide)) AS s0 FROM w, (SELECT DISTINCT wide FROM t))),
s AS (SELECT n, label, len(list_intersect(l.words, t.words)) / len(t.words) AS containment FROM l JOIN t USING (wide)
      WHERE len(list_intersect(l.words, t.words)) >= ceil({licenses.THRESHOLD} * len(t.words) - 1e-9)),
m AS (SELECT n, list(DISTINCT label) AS labels, max(containment) AS score FROM s GROUP BY n)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(b.n_base, 0)::BIGINT AS n_base, b.first_word::BIGINT AS first_word, b.last_word::BIGINT AS last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       greatest(CASE WHEN b.n_base > 0 THEN 1.0 ELSE 0.0 END, coalesce(m.score, 0.0))::DOUBLE AS score
FROM w LEFT JOIN b USING (n) LEFT JOIN m USING (n)
"""


ORACLE["op6_license_scan"] = license_sql()


ORACLE["op9_minhash_near_dedup"] = rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS n, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT n, doc_id, CASE WHEN len(words) >= 3 THEN list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i : i + 2])) WHEN len(words) > 0 THEN [words] ELSE [] END AS held FROM w),
x AS (SELECT n, hash(unnest(held)) AS g FROM s WHERE doc_id IS NOT NULL),
shared AS (SELECT a.n AS a, b.n AS b, count(*) AS n FROM x a JOIN x b ON a.g = b.g AND a.n < b.n GROUP BY ALL),
links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM shared JOIN s p ON p.n = shared.a JOIN s q ON q.n = shared.b WHERE 100 * shared.n >= 85 * (len(p.held) + len(q.held) - shared.n) AND p.doc_id <> q.doc_id),
e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
r AS (SELECT DISTINCT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT s.doc_id, len(held)::BIGINT AS n_shingles, coalesce(component, s.doc_id) AS component_id, s.doc_id IS NOT DISTINCT FROM coalesce(component, s.doc_id) AS kept FROM s LEFT JOIN c ON c.node = s.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
