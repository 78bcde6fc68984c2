"""Tokens, sentences and n-grams."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from textspark.catalog.cleaning import sql_sentences
from textspark.catalog.fixtures import ALNUM, DOCS_SQL, RAW, W, WORDS, WS, documents, table
from textspark.catalog.registry import query
from textspark.functions import tokens
from textspark.functions.udf import map_column, python_column


def _listed(spark, sf, items):
    rows = documents(spark, sf).select("doc_id", items.alias("t"))
    return rows.select("doc_id", F.size("t").cast("bigint").alias("n"), F.array_join("t", "|").alias("tokens"))


def _sql_listed(expr: str) -> str:
    return f"""SELECT doc_id, len(t)::BIGINT AS n, array_to_string(t, '|') AS tokens
    FROM (SELECT doc_id, {expr} AS t FROM documents)"""


@query("word_tokens", _sql_listed(WORDS))
def word_tokens(spark, sf):
    return _listed(spark, sf, tokens.word_tokens(F.col("text")))


@query("symbol_tokens", _sql_listed(rf"regexp_extract_all(lower(text), '{W}+|[^\p{{L}}\p{{N}}_\s\x1c-\x1f\x85\p{{Z}}]+')"))
def symbol_tokens(spark, sf):
    return _listed(spark, sf, tokens.symbol_tokens(F.col("text")))


@query("raw_tokens", _sql_listed(RAW))
def raw_tokens(spark, sf):
    return _listed(spark, sf, tokens.raw_tokens(F.col("text")))


@query("alnum_tokens", _sql_listed(rf"regexp_extract_all(text, '{ALNUM}')"))
def alnum_tokens(spark, sf):
    return _listed(spark, sf, tokens.alnum_tokens(F.col("text")))


@query("space_tokens", _sql_listed("string_split(text, ' ')"))
def space_tokens(spark, sf):
    return _listed(spark, sf, tokens.space_tokens(F.col("text")))


@query("sentences", _sql_listed(sql_sentences("text")))
def sentences(spark, sf):
    return _listed(spark, sf, tokens.sentences(F.col("text")))


@query(
    "all_sentences",
    rf"""WITH {DOCS_SQL}, s AS (SELECT doc_id, list_concat([title], {sql_sentences("body")}) AS l FROM docs)
    SELECT doc_id, (generate_subscripts(l, 1) - 1)::BIGINT AS pos, unnest(l) AS sentence FROM s""",
)
def all_sentences(spark, sf):
    every = F.concat(F.array("title"), tokens.sentences(F.col("body")))
    return documents(spark, sf).select("doc_id", F.posexplode(every).alias("pos", "sentence")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def _sql_bigrams(words: str) -> str:
    return f"list_transform(generate_series(1, len({words}) - 1), lambda i: {words}[i] || ' ' || {words}[i + 1])"


def _sql_digest(source: str) -> str:
    """Length of each document's list and a digest of it, order included; `source` gives (doc_id, l)."""
    return f"SELECT doc_id, len(l)::BIGINT AS n, md5(array_to_string(l, chr(31))) AS digest FROM ({source})"


def _digest(spark, sf, grams):
    listed = F.coalesce(grams, F.array().cast("array<string>"))
    return documents(spark, sf).select(
        "doc_id", F.size(listed).cast("bigint").alias("n"), F.md5(F.array_join(listed, "\x1f")).alias("digest")
    )


@query("word_ngrams", _sql_digest(f"SELECT doc_id, list_concat(w, {_sql_bigrams('w')}) AS l FROM (SELECT doc_id, {WORDS} AS w FROM documents)"))
def word_ngrams(spark, sf):
    return _digest(spark, sf, tokens.word_ngrams(tokens.word_tokens(F.col("text")), 1, 2))


@query(
    "sentence_ngrams",
    _sql_digest(
        rf"""SELECT doc_id, flatten(list_transform(list_transform({sql_sentences("text")},
        lambda s: regexp_extract_all(lower(s), '{W}{{2,}}')), lambda w: {_sql_bigrams("w")})) AS l FROM documents"""
    ),
)
def sentence_ngrams(spark, sf):
    return _digest(spark, sf, tokens.sentence_ngrams(F.col("text"), tokens.word_tokens, 2, 2))


@query(
    "char_ngrams",
    _sql_digest(
        rf"""SELECT doc_id, list_transform(generate_series(1, len(s) - 3), lambda i: s[i] || s[i + 1] || s[i + 2] || s[i + 3]) AS l
        FROM (SELECT doc_id, string_split(regexp_replace(lower(text), '{WS}{{2,}}', ' ', 'g'), '') AS s FROM documents)"""
    ),
)
def char_ngrams(spark, sf):
    return _digest(spark, sf, tokens.char_ngrams(F.col("text"), 4, 4))


@query(
    "char_wb_ngrams",
    _sql_digest(
        rf"""SELECT doc_id, flatten(list_transform(list_filter(regexp_split_to_array(lower(text), '{WS}+'), lambda x: x <> ''),
        lambda w: CASE WHEN length(w) < 2 THEN [' ' || w || ' ']
          ELSE list_transform(generate_series(1, length(w) - 1), lambda i: substr(' ' || w || ' ', i, 4)) END)) AS l FROM documents"""
    ),
)
def char_wb_ngrams(spark, sf):
    return _digest(spark, sf, tokens.char_wb_ngrams(F.col("text"), 4, 4))


def _python_tokens(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text)


@query("custom_tokenizer", _sql_listed(rf"regexp_extract_all(text, '{ALNUM}')"))
def custom_tokenizer(spark, sf):
    return _listed(spark, sf, python_column(_python_tokens, "array<string>")(F.col("text")))


def _vowels(text: str) -> int:
    return sum(c in "aeiou" for c in text)


@query("map_column", "SELECT doc_id, len(regexp_extract_all(text, '[aeiou]'))::BIGINT AS vowels FROM documents")
def map_column_query(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return map_column(docs, "text", _vowels, "bigint", "vowels").drop("text")
