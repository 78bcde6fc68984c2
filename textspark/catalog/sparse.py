"""Sparse vectors, vocabularies and their similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from textspark.catalog.fixtures import (
    BOW_SQL, DOCS_SQL, STOP_SQL, W, WORDS, documents, r6, s6, stop_list, table,
)
from textspark.catalog.registry import query
from textspark.functions import tokens
from textspark.functions.arrays import bind
from textspark.functions.arrays import value_counts
from textspark.operators import sparse
from textspark.plans import heavy_keys, lookup_join, top_k_per_group

_N = "(SELECT count(*) FROM documents)"
STATS_SQL = "stats AS (SELECT term, count(*) AS df, sum(n)::BIGINT AS total FROM bow GROUP BY term)"
IDF = f"(ln(({_N} + 1.0) / (df + 1.0)) + 1.0)"
TFIDF_SQL = f"""{BOW_SQL}, {STATS_SQL},
tfidf AS (SELECT doc_id, term, n * {IDF} AS value FROM bow JOIN stats USING (term))"""


def bow_of(spark, sf):
    return sparse.bag_of_words(documents(spark, sf), "doc_id", tokens.word_tokens(F.col("text")))


def n_docs(spark, sf):
    return sparse.row_count(table(spark, sf, "documents"))


def tfidf_of(spark, sf):
    bow = bow_of(spark, sf)
    return sparse.tfidf(bow, sparse.fit_terms(bow), n_docs(spark, sf))


@query("bow", f"WITH {BOW_SQL} SELECT doc_id, term, n FROM bow")
def bow(spark, sf):
    return bow_of(spark, sf)


@query("tf_only", f"WITH {BOW_SQL} SELECT doc_id, term, n::DOUBLE AS value FROM bow")
def tf_only(spark, sf):
    return sparse.tf(bow_of(spark, sf))


@query("tfidf", f"WITH {TFIDF_SQL} SELECT doc_id, term, {s6('value')} AS value FROM tfidf")
def tfidf(spark, sf):
    return tfidf_of(spark, sf).withColumn("value", r6("value"))


@query(
    "tfidf_l2",
    f"""WITH {TFIDF_SQL} SELECT doc_id, term,
    {s6("value / sqrt(sum(value * value) OVER (PARTITION BY doc_id))")} AS value FROM tfidf""",
)
def tfidf_l2(spark, sf):
    return sparse.normalize(tfidf_of(spark, sf), "doc_id").withColumn("value", r6("value"))


@query(
    "row_norms",
    f"""WITH {BOW_SQL} SELECT doc_id, term, {s6("n::DOUBLE / sum(n) OVER (PARTITION BY doc_id)")} AS l1,
    {s6("n::DOUBLE / max(n) OVER (PARTITION BY doc_id)")} AS top FROM bow""",
)
def row_norms(spark, sf):
    rows = sparse.tf(bow_of(spark, sf)).withColumn("l1", F.col("value")).withColumnRenamed("value", "top")
    rows = sparse.normalize(sparse.normalize(rows, "doc_id", "l1", "l1"), "doc_id", "max", "top")
    return rows.withColumns({"l1": r6("l1"), "top": r6("top")})


_PRUNED = f"pruned AS (SELECT term, df, total FROM stats WHERE df >= 3 AND df <= 0.5::DOUBLE * {_N})"


@query("df_prune", f"WITH {BOW_SQL}, {STATS_SQL}, {_PRUNED} SELECT doc_id, term, n FROM bow SEMI JOIN pruned USING (term)")
def df_prune(spark, sf):
    bow = bow_of(spark, sf)
    stats = sparse.fit_terms(bow)
    kept = sparse.prune(stats, n_docs(spark, sf), 3, 0.5)
    return lookup_join(bow, kept.select("term"), ["term"], heavy_keys(stats, ["term"], "df"))


@query(
    "bow_stop",
    f"WITH {BOW_SQL}, {STOP_SQL} SELECT doc_id, term, n FROM bow WHERE term NOT IN (SELECT term FROM stop)",
)
def bow_stop(spark, sf):
    words = sparse.without(tokens.word_tokens(F.col("text")), stop_list(spark, sf))
    return sparse.bag_of_words(documents(spark, sf), "doc_id", words)


_VOCAB = "vocab AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS idx FROM stats)"


@query("vocab_fit", f"WITH {BOW_SQL}, {STATS_SQL}, {_VOCAB} SELECT term, idx, df FROM vocab")
def vocab_fit(spark, sf):
    return sparse.Vocabulary.fit(bow_of(spark, sf)).terms


_NEW_BOW = f"""new_tok AS (SELECT item_id, unnest({WORDS}) AS term FROM benchmark),
new_bow AS (SELECT item_id, term, count(*) AS n FROM new_tok GROUP BY item_id, term)"""


def _new_bow(spark, sf):
    return sparse.bag_of_words(table(spark, sf, "benchmark"), "item_id", tokens.word_tokens(F.col("text")))


@query(
    "vocab_transform",
    f"""WITH {BOW_SQL}, {STATS_SQL}, kept AS (SELECT term, df FROM stats WHERE df >= 2),
    vocab AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS idx FROM kept), {_NEW_BOW}
    SELECT item_id, idx, term, n FROM new_bow JOIN vocab USING (term)""",
)
def vocab_transform(spark, sf):
    vocabulary = sparse.Vocabulary.fit(bow_of(spark, sf), n_docs(spark, sf), min_df=2)
    return vocabulary.transform(_new_bow(spark, sf)).select("item_id", "idx", "term", "n")


@query(
    "bow_cased",
    rf"""SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{W}{{2,}}')) AS term
    FROM documents) GROUP BY doc_id, term""",
)
def bow_cased(spark, sf):
    return sparse.bag_of_words(documents(spark, sf), "doc_id", tokens.word_tokens(F.col("text"), lowercase=False))


@query(
    "stacked",
    rf"""WITH t AS (SELECT doc_id, ' ' || unnest(list_filter(regexp_split_to_array(lower(text), '[\s\x1c-\x1f\x85\p{{Z}}]+'),
      lambda x: x <> '')) || ' ' AS w FROM documents),
    g AS (SELECT doc_id, unnest(CASE WHEN length(w) < 3 THEN [w]
      ELSE list_transform(generate_series(1, length(w) - 2), lambda i: substr(w, i, 3)) END) AS term FROM t),
    {BOW_SQL}, both_spaces AS (SELECT 'char' AS space, doc_id, term, count(*) AS n FROM g GROUP BY doc_id, term
      UNION ALL SELECT 'word', doc_id, term, n FROM bow)
    SELECT space, doc_id, count(*) AS n_terms, md5(string_agg(term || ':' || n, chr(31) ORDER BY term)) AS digest
    FROM both_spaces GROUP BY space, doc_id""",
)
def stacked(spark, sf):
    docs = documents(spark, sf)
    spaces = sparse.stack({
        "word": sparse.bags(docs, "doc_id", tokens.word_tokens(F.col("text"))),
        "char": sparse.bags(docs, "doc_id", tokens.char_wb_ngrams(F.col("text"), 3, 3)),
    })
    listed = lambda cells: F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["term"], c["n"].cast("string"))), "\x1f")
    digest = lambda cells: F.struct(F.size(cells).cast("bigint").alias("n_terms"), F.md5(listed(cells)).alias("digest"))
    # A generator, so that the cells are made once and not again for a filter.
    shown = bind(F.col("cells"), lambda cells: F.when(F.size(cells) > 0, F.array(digest(cells))))
    return spaces.select("space", "doc_id", F.inline(shown))


@query(
    "per_column",
    rf"""WITH {DOCS_SQL}, t AS (
      SELECT doc_id, unnest(regexp_extract_all(lower(title), '{W}{{2,}}')) || ' (title)' AS term FROM docs
      UNION ALL SELECT doc_id, unnest(regexp_extract_all(lower(body), '{W}{{2,}}')) || ' (body)' FROM docs)
    SELECT doc_id, term, count(*) AS n FROM t GROUP BY doc_id, term""",
)
def per_column(spark, sf):
    columns = {c: tokens.word_tokens(F.col(c)) for c in ("title", "body")}
    return sparse.per_column(documents(spark, sf), "doc_id", columns)


@query(
    "weighted_bow",
    rf"""WITH {DOCS_SQL}, t AS (
      SELECT doc_id, 2 AS w, unnest(regexp_extract_all(lower(title), '{W}{{2,}}')) AS term FROM docs
      UNION ALL SELECT doc_id, 1, unnest(regexp_extract_all(lower(body), '{W}{{2,}}')) FROM docs)
    SELECT doc_id, term, sum(w)::BIGINT AS n FROM t GROUP BY doc_id, term""",
)
def weighted_bow(spark, sf):
    parts = [(tokens.word_tokens(F.col("title")), 2), (tokens.word_tokens(F.col("body")), 1)]
    return sparse.weighted_bag(documents(spark, sf), "doc_id", parts)


_WIDE = ["the", "de", "la", "und", "of"]


@query(
    "bow_wide",
    f"WITH {BOW_SQL} SELECT doc_id, "
    + ", ".join(f"coalesce(sum(n) FILTER (term = '{t}'), 0)::BIGINT AS \"{t}\"" for t in _WIDE)
    + f" FROM bow WHERE term IN {tuple(_WIDE)} GROUP BY doc_id",
)
def bow_wide(spark, sf):
    return sparse.wide(bow_of(spark, sf), "doc_id", _WIDE)


@query(
    "doc_terms",
    f"""WITH {BOW_SQL}, {STATS_SQL}, {_NEW_BOW}
    SELECT item_id, term, {s6(f"n * {IDF}")} AS value FROM new_bow JOIN stats USING (term)""",
)
def doc_terms(spark, sf):
    """Non-zero features of every unseen text under the fitted weights."""
    stats = sparse.fit_terms(bow_of(spark, sf))
    return sparse.tfidf(_new_bow(spark, sf), stats, n_docs(spark, sf)).withColumn("value", r6("value"))


@query(
    "cosine_sparse",
    f"""WITH {BOW_SQL}, pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
    norms AS (SELECT doc_id, sum(n * n)::DOUBLE AS sq FROM bow GROUP BY doc_id),
    dots AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(x.n * y.n)::DOUBLE AS dot
      FROM bow x JOIN bow y ON y.doc_id = x.doc_id + 1 AND y.term = x.term GROUP BY x.doc_id, y.doc_id)
    SELECT a, b, {s6("coalesce(dot, 0.0) / (sqrt(na.sq) * sqrt(nb.sq))")} AS cosine
    FROM pairs LEFT JOIN dots USING (a, b) LEFT JOIN norms na ON na.doc_id = a LEFT JOIN norms nb ON nb.doc_id = b""",
)
def cosine_sparse(spark, sf):
    """Each document with the one that follows it."""
    ids = table(spark, sf, "documents").select(F.col("doc_id").alias("b"))
    pairs = ids.select((F.col("b") - 1).alias("a"), "b").join(ids.select(F.col("b").alias("a")), "a", "left_semi")
    rows = sparse.tf(bow_of(spark, sf))
    return sparse.cosine_pairs(rows, "doc_id", pairs).withColumn("cosine", r6("cosine"))


@query(
    "top_tfidf_terms",
    f"""WITH {TFIDF_SQL}, s AS (SELECT lang, term, sum(value) AS total FROM tfidf JOIN documents USING (doc_id) GROUP BY lang, term),
    r AS (SELECT lang, term, total, row_number() OVER (PARTITION BY lang ORDER BY round(total, 6) DESC, term) AS rank FROM s)
    SELECT lang, term, {s6("total")} AS total, rank FROM r WHERE rank <= 10""",
)
def top_tfidf_terms(spark, sf):
    """The ten terms of every language with the largest summed TF-IDF.

    idf is one number per term, so the sum over a language is its term count times idf: counts are summed
    first, and only one row per language and term meets the idf table.
    """
    docs = documents(spark, sf)
    bow = docs.select("doc_id", "lang", F.inline(value_counts(tokens.word_tokens(F.col("text")))).alias("term", "n"))
    per_lang = bow.groupBy("lang", "term").agg(F.count("*").alias("df"), F.sum("n").alias("n"))
    stats = per_lang.groupBy("term").agg(F.sum("df").alias("df"))
    idf = sparse.with_idf(stats, n_docs(spark, sf)).select("term", "idf")
    summed = per_lang.join(idf, "term").select("lang", "term", r6(F.col("n") * F.col("idf")).alias("total"))
    return top_k_per_group(summed, ["lang"], [F.desc("total"), F.col("term")], 10).withColumn(
        "rank", F.col("rank").cast("bigint")
    )

