"""Inputs shared by the queries, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.functions.tokens import alnum_tokens, raw_tokens
from textspark.operators.corpus import document_frequency, most_common, word_counts
from textspark.plans import durable, row_index
from textspark.sources.tables import read_table, spread

N_STOP = 20

# SQL pieces -----------------------------------------------------------------------------------------------
W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
ALNUM = r"[\p{L}\p{N}]+"
WORDS = rf"regexp_extract_all(lower(text), '{W}{{2,}}')"
RAW = rf"regexp_extract_all(lower(text), '{W}+')"

DOCS_SQL = """docs AS (
  SELECT doc_id, text, lang, source, [lang, source] AS labels, split_part(text, chr(10), 1) AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS body
  FROM documents)"""
BOW_SQL = f"""tok AS (SELECT doc_id, unnest({WORDS}) AS term FROM documents),
bow AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY doc_id, term)"""
STOP_SQL = f"""stop AS (
  SELECT term FROM (SELECT unnest({RAW}) AS term FROM documents)
  GROUP BY term ORDER BY count(*) DESC, term LIMIT {N_STOP})"""
VECTORS_SQL = f"""word_df AS (
  SELECT word, count(*) AS df
  FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{ALNUM}')) AS word FROM documents)
  GROUP BY word),
ranked AS (SELECT word, df, row_number() OVER (ORDER BY df DESC, word) - 1 AS vec_id FROM word_df),
emb AS (SELECT r.word, r.vec_id, e.embedding::DOUBLE[] AS embedding
        FROM ranked r JOIN embeddings e ON r.vec_id = e.vec_id)"""


# Spark inputs ---------------------------------------------------------------------------------------------
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, lang, source; split into title (first line) and body (the rest)."""
    raw = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    line_end = F.instr("text", "\n")
    return raw.withColumns(
        {
            "labels": F.array("lang", "source"),
            "title": F.substring_index("text", "\n", 1),
            "body": F.when(line_end > 0, F.substring("text", line_end + 1, F.length("text"))).otherwise(""),
        }
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "pages"))


def stop_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most frequent tokens of the corpus, as a (term) frame."""
    return most_common(word_counts(documents(spark, sf_dir), raw_tokens(F.col("text"))), N_STOP).select("term")


def stop_list(spark: SparkSession, sf_dir: str) -> list[str]:
    return [row.term for row in stop_terms(spark, sf_dir).collect()]


_VECTORS: dict[tuple[str, str], DataFrame] = {}


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, embedding, vec_id): the embedding table, keyed by words in order of document frequency.

    Stands for a stored table of word vectors, so it is built once per session.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _VECTORS:
        words = document_frequency(documents(spark, sf_dir), alnum_tokens(F.col("text"), lowercase=True))
        ranked = row_index(words, [F.desc("df"), F.col("term")], "vec_id")
        vectors = read_table(spark, sf_dir, "embeddings")
        _VECTORS[key] = durable(
            ranked.join(vectors, "vec_id").select(F.col("term").alias("word"), "embedding", "vec_id")
        )
    return _VECTORS[key]


def words_ranked(spark: SparkSession, sf_dir: str, first: int, last: int) -> list[str]:
    """A few named words: those at the given places of the frequency order."""
    picked = word_vectors(spark, sf_dir).filter(F.col("vec_id").between(first, last)).orderBy("vec_id")
    return [row.word for row in picked.select("word").collect()]


# Output helpers -------------------------------------------------------------------------------------------
def r6(value: Column | str) -> Column:
    """Rounded to 6 places, without a negative zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, 6) + F.lit(0.0)


def s6(expr: str) -> str:
    """SQL twin of r6."""
    return f"round(({expr})::DOUBLE, 6) + 0.0"
