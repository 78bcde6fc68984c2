"""Queries over near copies and repeated passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textspark.llm.contamination import contaminated
from textspark.llm.debruijn import without_repeats
from textspark.llm.near import near_duplicates
from textspark.llm.queries import query
from textspark.llm.suffixes import without_passages
from textspark.sources.tables import read_table

#: Words of a text in DuckDB: A-Z folded, cut at the six ASCII blanks.
FOLDED_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
)

NEAR_SQL = f"""
WITH RECURSIVE words AS (SELECT doc_id, {FOLDED_WORDS} AS w FROM documents),
cells AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END AS s FROM words), UNNEST(s) AS u(shingle)),
sizes AS (SELECT doc_id, count(*) AS n FROM cells GROUP BY 1),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM cells x JOIN cells y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY 1, 2) p JOIN sizes m ON p.a = m.doc_id JOIN sizes n ON p.b = n.doc_id
  WHERE 100 * both_have >= 75 * (m.n + n.n - both_have)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op5_minhash_near_dedup", NEAR_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


CONTAINED_SQL = f"""
WITH parts AS (
  SELECT 'd' AS kind, doc_id AS id, {FOLDED_WORDS} AS w FROM documents UNION ALL SELECT 'i', item_id, {FOLDED_WORDS} FROM benchmark),
cells AS (
  SELECT DISTINCT kind, id, shingle FROM (
    SELECT kind, id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END AS s FROM parts), UNNEST(s) AS u(shingle)),
sizes AS (SELECT id, count(*) AS n FROM cells WHERE kind = 'i' GROUP BY 1),
pairs AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM cells d JOIN cells i ON d.shingle = i.shingle
  WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_item, n_shared, n_shared / n AS containment
FROM pairs JOIN sizes ON id = item_id WHERE n_shared >= 0.5 * n
"""


@query("op4_benchmark_decontamination", CONTAINED_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _covered_sql(length: int) -> str:
    return f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {length - 1}], ' ') AS win
  FROM words, UNNEST(range(1, len(w) - {length - 2})) AS u(i)),
covered AS (
  SELECT DISTINCT doc_id, j FROM (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first FROM windows), UNNEST(range(i, i + {length})) AS u(j) WHERE first < doc_id),
cut AS (SELECT doc_id, list(j) AS js FROM covered GROUP BY 1),
kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(js), 0) AS n_removed,
    list_transform(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(coalesce(js, []), x)), lambda x: w[x]) AS k
  FROM words LEFT JOIN cut USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


@query("op6_substring_dedup", _covered_sql(13))
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op8_suffix_array_dedup", _covered_sql(50))
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")
