"""Word and document embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from textspark.catalog.fixtures import (
    ALNUM, VECTORS_SQL, documents, r6, s6, table, word_vectors, words_ranked,
)
from textspark.catalog.registry import query
from textspark.catalog.sparse import TFIDF_SQL, n_docs
from textspark.functions import tokens
from textspark.functions.arrays import value_counts
from textspark.operators import clusters, corpus, dense, sparse

_NEW_WORDS = f"""new_words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{ALNUM}')) AS word FROM benchmark)"""


def _new_words(spark, sf):
    found = tokens.alnum_tokens(F.col("text"), lowercase=True)
    return table(spark, sf, "benchmark").select(F.explode(found).alias("word")).distinct()


@query(
    "emb_lookup",
    f"""WITH {VECTORS_SQL}, {_NEW_WORDS} SELECT n.word, e.word IS NOT NULL AS found,
    list_transform(e.embedding, lambda x: {s6("x::DOUBLE")}) AS embedding FROM new_words n LEFT JOIN emb e USING (word)""",
)
def emb_lookup(spark, sf):
    found = dense.lookup(word_vectors(spark, sf).drop("vec_id"), _new_words(spark, sf))
    return found.select("word", "found", F.transform("embedding", lambda x: r6(x.cast("double"))).alias("embedding"))


@query(
    "cosine_dense",
    f"""SELECT a.vec_id AS a, b.vec_id AS b,
    {s6("list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])")} AS cosine
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def cosine_dense(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    ids = vectors.select(F.col("vec_id").alias("b"))
    pairs = ids.select((F.col("b") - 1).alias("a"), "b").join(ids.select(F.col("b").alias("a")), "a", "left_semi")
    return dense.cosine_of_pairs(vectors, "vec_id", pairs).withColumn("cosine", r6("cosine"))


def _ranked(source: str, k: int, by: str = "") -> str:
    return f"""SELECT *, row_number() OVER ({by} ORDER BY similarity DESC, word) AS rank FROM ({source})
    QUALIFY rank <= {k}"""


@query(
    "most_similar",
    f"""WITH {VECTORS_SQL}, r AS ({_ranked('''SELECT q.word AS query, e.word,
      list_cosine_similarity(q.embedding, e.embedding) AS similarity
      FROM emb q JOIN emb e ON e.word <> q.word WHERE q.vec_id BETWEEN 20 AND 24''', 10, "PARTITION BY query")})
    SELECT query, word, {s6("similarity")} AS similarity, rank FROM r""",
)
def most_similar(spark, sf):
    vectors = word_vectors(spark, sf)
    near = dense.most_similar(vectors, words_ranked(spark, sf, 20, 24), 10)
    return near.select("query", "word", r6("similarity").alias("similarity"), F.col("rank").cast("bigint").alias("rank"))


_UNIT = "list_transform(embedding, lambda x: x / sqrt(list_sum(list_transform(embedding, lambda y: y * y))))"


@query(
    "analogy",
    f"""WITH {VECTORS_SQL}, u AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest({_UNIT}) AS x
      FROM emb WHERE vec_id BETWEEN 20 AND 22),
    m AS (SELECT dim, avg(CASE WHEN vec_id = 22 THEN -x ELSE x END) AS x FROM u GROUP BY dim),
    v AS (SELECT list(x ORDER BY dim) AS vec FROM m),
    r AS ({_ranked('''SELECT word, list_cosine_similarity(vec, embedding) AS similarity FROM emb, v
      WHERE vec_id NOT BETWEEN 20 AND 22''', 10)})
    SELECT word, {s6("similarity")} AS similarity, rank FROM r""",
)
def analogy(spark, sf):
    words = words_ranked(spark, sf, 20, 22)
    near = dense.analogy(word_vectors(spark, sf), words[:2], words[2:], 10)
    return near.select("word", r6("similarity").alias("similarity"), F.col("rank").cast("bigint").alias("rank"))


@query(
    "similar_by_vector",
    f"""WITH {VECTORS_SQL}, c AS (SELECT unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS dim
      FROM embeddings WHERE label = 3), m AS (SELECT dim, avg(x) AS x FROM c GROUP BY dim),
    v AS (SELECT list(x ORDER BY dim) AS vec FROM m),
    r AS ({_ranked("SELECT word, list_cosine_similarity(vec, embedding) AS similarity FROM emb, v", 10)})
    SELECT word, {s6("similarity")} AS similarity, rank FROM r""",
)
def similar_by_vector(spark, sf):
    """Words nearest to the centre of one label's vectors."""
    group = table(spark, sf, "embeddings").filter("label = 3")
    cells = [F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(64)]
    near = dense.similar_by_vector(word_vectors(spark, sf), group.agg(F.array(*cells).alias("vec")), 10)
    return near.select("word", r6("similarity").alias("similarity"), F.col("rank").cast("bigint").alias("rank"))


def _space_words(spark, sf):
    """(doc_id, word, weight) of the texts split at single spaces."""
    return documents(spark, sf).select(
        "doc_id", F.inline(value_counts(tokens.space_tokens(F.lower("text")))).alias("word", "weight")
    )


_CELLS_SQL = f"""{VECTORS_SQL}, sp AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents),
spc AS (SELECT doc_id, word, count(*) AS n FROM sp GROUP BY doc_id, word),
cells AS (SELECT doc_id, n, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding) AS x FROM spc JOIN emb USING (word))"""


def _exploded(df, key, **columns):
    names = list(columns)
    zipped = df.select(key, F.posexplode(F.arrays_zip(*[F.col(c).alias(n) for n, c in columns.items()])).alias("dim", "z"))
    return zipped.select(key, F.col("dim").cast("bigint").alias("dim"), *[r6(F.col(f"z.{n}")).alias(n) for n in names])


@query(
    "pool_sum",
    f"WITH {_CELLS_SQL} SELECT doc_id, dim, {s6('sum(n * x)')} AS value FROM cells GROUP BY doc_id, dim",
)
def pool_sum(spark, sf):
    pooled = dense.pool(_space_words(spark, sf), word_vectors(spark, sf), "doc_id", ["sum"])
    return _exploded(pooled, "doc_id", value="sum")


@query(
    "pool_minmax",
    f"WITH {_CELLS_SQL} SELECT doc_id, dim, {s6('max(x)')} AS top, {s6('min(x)')} AS low FROM cells GROUP BY doc_id, dim",
)
def pool_minmax(spark, sf):
    pooled = dense.pool(_space_words(spark, sf), word_vectors(spark, sf), "doc_id", ["max", "min"])
    return _exploded(pooled, "doc_id", top="max", low="min")


@query(
    "pool_concat",
    f"""WITH {_CELLS_SQL} SELECT doc_id, dim, {s6('max(x)')} AS value FROM cells GROUP BY doc_id, dim
    UNION ALL SELECT doc_id, dim + 64, {s6('min(x)')} FROM cells GROUP BY doc_id, dim""",
)
def pool_concat(spark, sf):
    pooled = dense.pool(_space_words(spark, sf), word_vectors(spark, sf), "doc_id", ["max", "min"])
    return _exploded(pooled.select("doc_id", F.concat("max", "min").alias("both")), "doc_id", value="both")


@query(
    "doc_vectors",
    f"""WITH {TFIDF_SQL}, {VECTORS_SQL},
    cells AS (SELECT doc_id, generate_subscripts(embedding, 1) - 1 AS dim, value, unnest(embedding) AS x
      FROM tfidf JOIN emb ON emb.word = tfidf.term),
    sums AS (SELECT doc_id, dim, sum(value * x) AS v FROM cells GROUP BY doc_id, dim),
    every AS (SELECT doc_id, unnest(generate_series(0, 63)) AS dim FROM documents),
    f AS (SELECT doc_id, dim, coalesce(v, 0.0) AS v FROM every LEFT JOIN sums USING (doc_id, dim)),
    s AS (SELECT *, sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS size FROM f)
    SELECT doc_id, dim, {s6("CASE WHEN size = 0 THEN v ELSE v / size END")} AS value FROM s""",
)
def doc_vectors(spark, sf):
    docs = documents(spark, sf)
    bow = sparse.bag_of_words(docs, "doc_id", tokens.word_tokens(F.col("text")))
    idf = sparse.with_idf(sparse.fit_terms(bow), n_docs(spark, sf))
    scaled = dense.scale_vectors(word_vectors(spark, sf), idf.select(F.col("term").alias("word"), F.col("idf").alias("weight")))
    vectors = dense.document_vectors(bow.toDF("doc_id", "word", "weight"), scaled, docs, "doc_id")
    return _exploded(vectors, "doc_id", value="vector")


@query(
    "emb_coverage",
    f"""WITH {VECTORS_SQL} SELECT e.word IS NOT NULL AS found, count(*) AS n FROM word_df d LEFT JOIN emb e USING (word) GROUP BY 1""",
)
def emb_coverage(spark, sf):
    words = corpus.word_counts(documents(spark, sf), tokens.alnum_tokens(F.col("text"), lowercase=True))
    return dense.coverage(words.select(F.col("term").alias("word")), word_vectors(spark, sf))


@query(
    "oov_vector",
    f"""WITH {VECTORS_SQL}, {_NEW_WORDS}, unseen AS (SELECT word, '<' || word || '>' AS p FROM new_words ANTI JOIN emb USING (word)),
    sizes AS (SELECT word, p, unnest([3, 4, 5, 6]) AS k FROM unseen),
    grams AS (SELECT word, substr(p, unnest(generate_series(1, length(p) - k + 1)), k) AS gram FROM sizes WHERE length(p) >= k),
    b AS (SELECT word, ('0x' || substr(md5(gram), 1, 7))::BIGINT % (SELECT count(*) FROM embeddings) AS vec_id FROM grams),
    cells AS (SELECT word, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x
      FROM b JOIN embeddings USING (vec_id))
    SELECT word, dim, {s6("avg(x)")} AS value FROM cells GROUP BY word, dim""",
)
def oov_vector(spark, sf):
    unseen = _new_words(spark, sf).join(word_vectors(spark, sf), "word", "left_anti")
    buckets = table(spark, sf, "embeddings").select(F.col("vec_id").alias("bucket"), "embedding")
    return _exploded(dense.unseen_word_vectors(unseen, buckets), "word", value="vector")


@query(
    "neighbourhoods",
    f"""WITH {VECTORS_SQL}, seeds AS (SELECT vec_id - 20 AS grp, word, embedding FROM emb WHERE vec_id BETWEEN 20 AND 22),
    r AS ({_ranked('''SELECT s.grp, e.word, list_cosine_similarity(s.embedding, e.embedding) AS similarity
      FROM seeds s JOIN emb e ON e.word <> s.word''', 50, "PARTITION BY grp")})
    SELECT grp, word, rank, {s6("similarity")} AS similarity, true AS found FROM r
    UNION ALL SELECT grp, word, 0, NULL, true FROM seeds
    UNION ALL SELECT 3, '<no such word>', 0, NULL, false""",
)
def neighbourhoods(spark, sf):
    seeds = [*words_ranked(spark, sf, 20, 22), "<no such word>"]
    rows = dense.neighbourhoods(word_vectors(spark, sf), seeds, 50)
    return rows.withColumns({"similarity": r6("similarity"), "rank": F.col("rank").cast("bigint")})


@query(
    "emb_word_sample",
    f"""WITH {VECTORS_SQL}, c AS (SELECT word, count(*) AS n
      FROM (SELECT unnest(regexp_extract_all(lower(text), '{ALNUM}')) AS word FROM documents) GROUP BY word)
    SELECT word, n FROM c SEMI JOIN emb USING (word) WHERE n >= 10 ORDER BY md5('3' || word), word LIMIT 100""",
)
def emb_word_sample(spark, sf):
    counts = corpus.word_counts(documents(spark, sf), tokens.alnum_tokens(F.col("text"), lowercase=True))
    return dense.frequent_known_words(counts.toDF("word", "n"), word_vectors(spark, sf), 10, 100, seed=3)


EPS, MIN_SAMPLES = 0.1, 4


def _place(cycle: int):
    """A coordinate made from the whole vector: its places weighted by a repeating row of small numbers."""
    parts = F.transform("embedding", lambda x, i: x.cast("double") * (i % cycle - F.lit(cycle // 2)) / 4)
    return F.round(F.aggregate(parts, F.lit(0.0), lambda total, x: total + x), 4)


def _sql_place(cycle: int) -> str:
    return f"round(list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * ((i - 1) % {cycle} - {cycle // 2}) / 4)), 4)"


@query(
    "density_cluster",
    f"""WITH RECURSIVE pts AS (SELECT vec_id AS id, {_sql_place(5)} AS x, {_sql_place(7)} AS y FROM embeddings),
    near AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b
      ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}::DOUBLE * {EPS}::DOUBLE),
    core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {MIN_SAMPLES}),
    edges AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach AS (SELECT id AS a, id AS b FROM core UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
    comp AS (SELECT a AS id, min(b) AS cluster FROM reach GROUP BY a),
    border AS (SELECT n.a AS id, min(c.cluster) AS cluster FROM near n JOIN comp c ON n.b = c.id
      WHERE n.a NOT IN (SELECT id FROM core) GROUP BY n.a)
    SELECT id, cluster, true AS is_core FROM comp UNION ALL SELECT id, cluster, false FROM border""",
)
def density_cluster(spark, sf):
    points = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        _place(5).alias("x"),
        _place(7).alias("y"),
    )
    return clusters.density_clusters(points, EPS, MIN_SAMPLES)
