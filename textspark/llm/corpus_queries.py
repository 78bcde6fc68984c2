"""Queries over whole corpora: mixtures, aligned tokenizers, phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textspark.llm.alignment import tokenizer_alignment
from textspark.llm.collocations import collocations
from textspark.llm.mixture import taken_words
from textspark.llm.queries import query
from textspark.sources.tables import read_table


@query("op11_source_mixture")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(read_table(spark, sf_dir, "documents"))


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_alignment(read_table(spark, sf_dir, "documents"))


def _phrases_of(k: int) -> str:
    """SQL: counts of the phrases of k words, each seen from its first word."""
    words = " || ' ' || ".join(["w0", *(f"w{i}" for i in range(1, k))])
    whole = " AND ".join(f"w{i} IS NOT NULL" for i in range(k))
    return f"SELECT lang, {k} AS k, {words} AS phrase, count(*) AS f FROM seen WHERE {whole} GROUP BY ALL"


_CUT = "array_to_string(list_slice(string_split(c.phrase, ' '), {0}, {1}), ' ')"
OP13_SQL = f"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(p) AS piece, generate_subscripts(p, 1) AS place
  FROM (SELECT row_number() OVER () AS doc_id, lang,
               regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]') AS p FROM documents)),
tokens AS (
  SELECT doc_id, lang, place, unnest(w) AS w, generate_subscripts(w, 1) AS nth
  FROM (SELECT doc_id, lang, place, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)),
seen AS (
  SELECT lang, w AS w0, {", ".join(f"lead(w, {i}) OVER run AS w{i}" for i in range(1, 5))}
  FROM tokens WINDOW run AS (PARTITION BY doc_id, place ORDER BY nth)),
sizes AS (SELECT lang, count(*) AS n FROM tokens GROUP BY lang),
counts AS MATERIALIZED ({" UNION ALL ".join(_phrases_of(k) for k in range(1, 6))}),
candidates AS MATERIALIZED (SELECT * FROM counts WHERE k > 1 AND f >= 100),
cuts AS (SELECT c.lang, c.k, c.phrase, c.f, unnest(range(1, c.k)) AS cut FROM candidates c),
parted AS (
  SELECT c.*, l.f AS l, r.f AS r, s.n, (1000 * c.f::HUGEINT * s.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.k = c.cut AND l.phrase = {_CUT.format(1, "c.cut")}
  JOIN counts r ON r.lang = c.lang AND r.k = c.k - c.cut AND r.phrase = {_CUT.format("c.cut + 1", "c.k")}
  JOIN sizes s ON s.lang = c.lang),
worst AS (SELECT * FROM parted QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT c.lang, {_CUT.format("b.begin", "b.begin + b.size - 1")} AS phrase, b.size, c.f
  FROM candidates c, (SELECT i AS begin, j AS size FROM range(1, 5) a(i), range(2, 5) s(j)) b
  WHERE b.size < c.k AND b.begin + b.size - 1 <= c.k),
alone AS (
  SELECT * FROM worst w
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = w.lang AND i.phrase = w.phrase AND 100 * i.f >= 100 * w.f))
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase, f AS a, l, r, n, score::BIGINT AS score FROM alone)
WHERE rank <= 2000"""


@query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))
