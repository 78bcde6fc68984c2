"""Corpus statistics, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from textspark.catalog.cleaning import sql_sentences
from textspark.catalog.fixtures import (
    ALNUM, STOP_SQL, WORDS, documents, r6, s6, stop_terms, table,
)
from textspark.catalog.registry import query
from textspark.functions import tokens
from textspark.operators import corpus, sampling

_COUNT_SQL = f"""words AS (SELECT term, count(*) AS n FROM
  (SELECT unnest(regexp_extract_all(lower(text), '{ALNUM}')) AS term FROM documents) GROUP BY term)"""


def _counts(spark, sf):
    return corpus.word_counts(documents(spark, sf), tokens.alnum_tokens(F.col("text"), lowercase=True))


@query("word_count", f"WITH {_COUNT_SQL} SELECT term, n FROM words")
def word_count(spark, sf):
    return _counts(spark, sf)


@query("top_words", f"WITH {_COUNT_SQL} SELECT term, n FROM words ORDER BY n DESC, term LIMIT 30")
def top_words(spark, sf):
    return corpus.most_common(_counts(spark, sf), 30)


@query(
    "top_not_stop",
    f"""WITH {_COUNT_SQL}, {STOP_SQL} SELECT term, n FROM words WHERE term NOT IN (SELECT term FROM stop)
    ORDER BY n DESC, term LIMIT 10""",
)
def top_not_stop(spark, sf):
    return corpus.most_common(_counts(spark, sf), 10, exclude=stop_terms(spark, sf))


@query("label_counts", "SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang")
def label_counts(spark, sf):
    return corpus.label_counts(table(spark, sf, "documents"), "lang")


@query(
    "rare_labels",
    """SELECT label, count(*) AS n FROM (SELECT lang || ' > ' || source AS label FROM documents)
    GROUP BY label ORDER BY n, label LIMIT 10""",
)
def rare_labels(spark, sf):
    label = F.concat_ws(" > ", "lang", "source").alias("label")
    return corpus.rare_labels(table(spark, sf, "documents").select(label), "label")


@query("label_nunique", "SELECT count(DISTINCT source) AS n_labels FROM documents")
def label_nunique(spark, sf):
    return corpus.distinct_label_count(table(spark, sf, "documents"), "source")


@query(
    "corpus_sizes",
    f"""SELECT count(*) AS n_docs, sum(len({sql_sentences("text")}))::BIGINT AS n_sentences,
    sum(len({WORDS}))::BIGINT AS n_tokens FROM documents""",
)
def corpus_sizes(spark, sf):
    text = F.col("text")
    return documents(spark, sf).agg(
        F.count("*").alias("n_docs"),
        F.sum(F.size(tokens.sentences(text))).alias("n_sentences"),
        F.sum(F.size(tokens.word_tokens(text))).alias("n_tokens"),
    )


@query(
    "label_terms",
    f"""WITH {STOP_SQL}, c AS (SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest({WORDS}) AS term FROM documents)
      WHERE term NOT IN (SELECT term FROM stop) GROUP BY lang, term),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rank FROM c)
    SELECT lang, term, n, rank FROM r WHERE rank <= 50""",
)
def label_terms(spark, sf):
    words = tokens.word_tokens(F.col("text"))
    top = corpus.label_terms(documents(spark, sf), "lang", words, stop_terms(spark, sf), 50)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "hapax_share",
    f"""WITH {_COUNT_SQL} SELECT {s6("avg(CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END)")} AS hapax_share,
    count(*) AS n_terms FROM words""",
)
def hapax_share(spark, sf):
    return corpus.hapax_share(_counts(spark, sf)).withColumn("hapax_share", r6("hapax_share"))


@query(
    "doc_freq",
    f"""SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({WORDS}) AS term FROM documents) GROUP BY term""",
)
def doc_freq(spark, sf):
    return corpus.document_frequency(documents(spark, sf), tokens.word_tokens(F.col("text")))


@query(
    "contrast_terms",
    f"""WITH t AS (SELECT lang = 'de' AS inside, unnest({WORDS}) AS term FROM documents),
    c AS (SELECT term, count(*) FILTER (inside) AS n_in, count(*) FILTER (NOT inside) AS n_out FROM t GROUP BY term
      HAVING count(*) >= 3),
    p AS (SELECT *, n_in::DOUBLE / (n_in + n_out) AS precision FROM c),
    r AS (SELECT *, percent_rank() OVER (ORDER BY precision) AS pp, percent_rank() OVER (ORDER BY n_in) AS pf FROM p)
    SELECT term, n_in, n_out, {s6("precision")} AS precision,
    {s6("CASE WHEN pp + pf > 0 THEN 2 * pp * pf / (pp + pf) ELSE 0.0 END")} AS score FROM r""",
)
def contrast_terms(spark, sf):
    words = tokens.word_tokens(F.col("text"))
    rows = corpus.contrast_terms(documents(spark, sf), F.col("lang") == "de", words, min_count=3)
    return rows.withColumns({"precision": r6("precision"), "score": r6("score")})


@query(
    "stratified_sample",
    """SELECT doc_id, lang FROM (SELECT doc_id, lang,
      row_number() OVER (PARTITION BY lang ORDER BY md5('7' || doc_id), doc_id) AS r FROM documents) WHERE r <= 60""",
)
def stratified_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.stratified_sample(docs, "lang", "doc_id", 60, 7)


@query(
    "quota_per_group",
    """SELECT doc_id, lang, rank FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rank
      FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) WHERE rank <= 20""",
)
def quota_per_group(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    seen = table(spark, sf, "labels").select("doc_id")
    rows = sampling.quota_per_group(docs, seen, "doc_id", "lang", [F.col("doc_id")], 20)
    return rows.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "strat_split",
    """SELECT doc_id, lang, r <= round(0.1::DOUBLE * n) AS is_test FROM (SELECT doc_id, lang,
      row_number() OVER (PARTITION BY lang ORDER BY md5('7' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n
      FROM documents)""",
)
def strat_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.stratified_split(docs, "lang", "doc_id", 0.1, 7)


@query(
    "batch_no",
    "SELECT event_id, ((row_number() OVER (ORDER BY ts, event_id) - 1) // 100)::BIGINT AS batch_no FROM events",
)
def batch_no(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_id")
    return sampling.batch_numbers(events, [F.col("ts"), F.col("event_id")]).select("event_id", "batch_no")
