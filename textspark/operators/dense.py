"""Dense vectors: pooling word embeddings per document, nearest words, analogies, sub-word vectors.

Embedding tables have the columns (word string, embedding array<float>), unique on word.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions.arrays import cosine, dot, norm2, unit
from textspark.functions.tokens import slices
from textspark.operators.sampling import sample_rows
from textspark.plans.lineage import durable
from textspark.plans.ranking import top_k_per_group
from textspark.plans.skew import heavy_keys, lookup_join
from textspark.plans.union import union_rows

# A broadcast slice of hot words stays near this many bytes whatever the embedding width.
_HOT_BYTES = 32 << 20
# Vector places per aggregation row.
_CHUNK = 16


def dimensions(embeddings: DataFrame) -> int:
    return int(embeddings.select(F.size("embedding").alias("d")).first()["d"])


def lookup(embeddings: DataFrame, words: DataFrame) -> DataFrame:
    """Vector of each asked word, with `found` false and a null vector for unknown ones."""
    return words.join(embeddings, "word", "left").withColumn("found", F.col("embedding").isNotNull())


def cosine_of_pairs(vectors: DataFrame, key: str, pairs: DataFrame, value: str = "embedding") -> DataFrame:
    """(a, b, cosine) for listed pairs of dense vectors."""
    side = vectors.select(key, value)
    return (
        pairs.join(side.toDF("a", "_va"), "a")
        .join(side.toDF("b", "_vb"), "b")
        .select("a", "b", cosine(F.col("_va"), F.col("_vb")).alias("cosine"))
    )


def nearest(embeddings: DataFrame, queries: DataFrame, k: int, exclude: Sequence[str] | None = None) -> DataFrame:
    """(qid, word, similarity, rank): the k words closest by cosine to each query vector (qid, vec).

    `queries` must be a short list (named words, not a table): it travels as one array value to every task,
    the embedding table is scanned once, and each map task keeps k rows per query before the shuffle.
    """
    asked = queries.agg(
        F.collect_list(F.struct("qid", unit(F.col("vec")).alias("vec"), norm2(F.col("vec")).alias("len")))
    ).scalar()
    table = embeddings if exclude is None else embeddings.filter(~F.col("word").isin(list(exclude)))
    pairs = table.select("word", unit(F.col("embedding")).alias("_u"), F.explode(asked).alias("q"))
    scored = pairs.filter(F.col("q.len") > 0).select(
        F.col("q.qid").alias("qid"), "word", dot(F.col("_u"), F.col("q.vec")).alias("similarity")
    )
    return top_k_per_group(scored, ["qid"], [F.desc("similarity"), F.col("word")], k)


def most_similar(embeddings: DataFrame, words: Sequence[str], k: int = 10) -> DataFrame:
    """(query, word, similarity, rank): k nearest words of each named word, itself excluded."""
    queries = embeddings.filter(F.col("word").isin(list(words))).select(
        F.col("word").alias("qid"), F.col("embedding").alias("vec")
    )
    # One more than k is kept, then the query word is dropped and the rest re-ranked.
    ranked = nearest(embeddings, queries, k + 1).filter(F.col("word") != F.col("qid"))
    return top_k_per_group(
        ranked.drop("rank"), ["qid"], [F.desc("similarity"), F.col("word")], k
    ).withColumnRenamed("qid", "query")


def similar_by_vector(embeddings: DataFrame, vector: DataFrame, k: int = 10) -> DataFrame:
    """(word, similarity, rank) nearest to one vector (a one-row frame with column vec)."""
    return nearest(embeddings, vector.select(F.lit(0).alias("qid"), "vec"), k).drop("qid")


def combine(embeddings: DataFrame, positive: Sequence[str], negative: Sequence[str] = ()) -> DataFrame:
    """One-row frame: the mean of unit vectors, negatives with a minus sign. Fails on an unknown word."""
    asked = [*positive, *negative]
    sign = F.when(F.col("word").isin(list(positive)), F.lit(1.0)).otherwise(F.lit(-1.0))
    dims = dimensions(embeddings)
    picked = embeddings.filter(F.col("word").isin(asked)).select(
        sign.alias("_sign"), unit(F.col("embedding")).alias("_u")
    )
    means = F.array(*[F.avg(F.col("_sign") * F.get("_u", F.lit(i))) for i in range(dims)])
    return picked.agg(F.count("*").alias("_n"), means.alias("vec")).select(
        F.when(F.col("_n") == len(set(asked)), F.col("vec"))
        .otherwise(F.raise_error(F.lit(f"a word has no embedding: {asked}")))
        .alias("vec")
    )


def analogy(
    embeddings: DataFrame, positive: Sequence[str], negative: Sequence[str], k: int = 10
) -> DataFrame:
    """(word, similarity, rank): nearest to positives minus negatives, the inputs excluded."""
    vec = combine(embeddings, positive, negative).select(F.lit(0).alias("qid"), "vec")
    return nearest(embeddings, vec, k, exclude=[*positive, *negative]).drop("qid")


def neighbourhoods(embeddings: DataFrame, seeds: Sequence[str], k: int = 50) -> DataFrame:
    """(grp, word, rank, similarity, found): every seed at rank 0 and its k neighbours.

    A seed without a vector is reported with found = false and has no neighbours.
    """
    spark = embeddings.sparkSession
    listed = spark.createDataFrame([(i, w) for i, w in enumerate(seeds)], "grp bigint, word string")
    known = embeddings.filter(F.col("word").isin(list(seeds))).select("word")
    seed_rows = listed.join(known.withColumn("found", F.lit(True)), "word", "left").select(
        "grp",
        "word",
        F.lit(0).alias("rank"),
        F.lit(None).cast("double").alias("similarity"),
        F.coalesce("found", F.lit(False)).alias("found"),
    )
    near = most_similar(embeddings, seeds, k).join(
        F.broadcast(listed.withColumnRenamed("word", "query")), "query"
    )
    return union_rows(seed_rows, 
        near.select("grp", "word", "rank", "similarity", F.lit(True).alias("found"))
    )


def _hot_words(weights: DataFrame, dims: int) -> DataFrame:
    per_word = weights.groupBy("word").agg(F.count("*").alias("_n"))
    return heavy_keys(per_word, ["word"], "_n", max_keys=max(64, _HOT_BYTES // (8 * dims)))


def weighted_vectors(
    weights: DataFrame, embeddings: DataFrame, key: str, dims: int | None = None
) -> DataFrame:
    """Joins (key, word, weight) to the embeddings: the hot words by a bounded broadcast, the rest shuffled."""
    dims = dims or dimensions(embeddings)
    return lookup_join(
        weights.select(key, "word", "weight"),
        embeddings.select("word", "embedding"),
        ["word"],
        _hot_words(weights, dims),
        row_bytes=8 * dims + 64,
    )


def _dimension_sums(rows: DataFrame, key: str, vector: str, dims: int, how: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One array per entry of `how`, aggregated dimension by dimension over the rows of a key.

    A vector is cut into short chunks and every place of a chunk is its own aggregate buffer, so partial
    vectors are combined map-side and no (key, dimension) rows are shuffled. Few buffers per aggregation keep
    the generated code small enough for the JVM to compile, however long the vectors are.
    """
    starts = range(0, dims, _CHUNK)
    chunks = F.posexplode(F.array(*[F.slice(vector, s + 1, _CHUNK) for s in starts])).alias("_c", "_v")
    carried = [c for c in rows.columns if c not in (key, vector)]
    parts = rows.select(key, *carried, chunks).groupBy(key, "_c")
    sums = parts.agg(
        *[F.array(*[fn(F.get("_v", F.lit(i))) for i in range(min(_CHUNK, dims))]).alias(name) for name, fn in how.items()]
    )
    ordered = {name: F.sort_array(F.collect_list(F.struct("_c", F.col(name).alias("v")))) for name in how}
    whole = sums.groupBy(key).agg(*[c.alias(name) for name, c in ordered.items()])
    # The last chunk may be short; its unused places are cut off.
    return whole.select(
        key, *[F.slice(F.flatten(F.transform(name, lambda c: c["v"])), 1, dims).alias(name) for name in how]
    )


def pool(
    weights: DataFrame, embeddings: DataFrame, key: str, how: Sequence[str], dims: int | None = None
) -> DataFrame:
    """One column per pooling of "sum", "max", "min": a vector per document over its known words.

    Documents without a known word are absent.
    """
    dims = dims or dimensions(embeddings)
    joined = weighted_vectors(weights, embeddings, key, dims).select(key, "weight", "embedding")
    make = {
        "sum": lambda x: F.sum(F.col("weight") * x.cast("double")),
        "max": lambda x: F.max(x.cast("double")),
        "min": lambda x: F.min(x.cast("double")),
    }
    return _dimension_sums(joined, key, "embedding", dims, {h: make[h] for h in how})


def scale_vectors(embeddings: DataFrame, weights: DataFrame) -> DataFrame:
    """Embeddings multiplied by a per-word weight (word, weight); words without one are left out.

    A weight that depends on the word alone, such as idf, is best folded in here: this join has one row per
    word, and the document table then needs a single join.
    """
    scaled = embeddings.join(weights, "word").select(
        "word", F.transform("embedding", lambda x: x.cast("double") * F.col("weight")).alias("embedding")
    )
    return durable(scaled)


def document_vectors(
    weights: DataFrame,
    embeddings: DataFrame,
    documents: DataFrame,
    key: str,
    norm: str | bool | None = "l2",
) -> DataFrame:
    """(key, vector): term weights times term vectors, rows normalised; a zero vector without known terms.

    The weights are used as fitted, term by term, whatever share of the vocabulary has a vector.
    """
    dims = dimensions(embeddings)
    joined = weighted_vectors(weights, embeddings, key, dims).select(
        key, F.col("weight").cast("double").alias("weight"), F.col("embedding").cast("array<double>").alias("vector")
    )
    zero = F.array_repeat(F.lit(0.0), dims)
    blank = documents.select(key, F.lit(1.0).alias("weight"), zero.alias("vector"))
    sums = _dimension_sums(
        union_rows(joined, blank), key, "vector", dims, {"vector": lambda x: F.sum(F.col("weight") * x)}
    )
    if not norm:
        return sums
    size = {
        "l2": norm2(F.col("vector")),
        "l1": F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.abs(x)),
        "max": F.array_max(F.transform("vector", F.abs)),
    }["l2" if norm is True else norm]
    return sums.withColumn("_size", size).select(
        key,
        F.transform(
            "vector", lambda x: F.when(F.col("_size") == 0, x).otherwise(F.try_divide(x, F.col("_size")))
        ).alias("vector"),
    )


def coverage(words: DataFrame, embeddings: DataFrame) -> DataFrame:
    """(found, n): how many of the distinct words have a vector."""
    known = embeddings.select("word", F.lit(True).alias("_known"))
    return (
        words.join(known, "word", "left")
        .groupBy(F.col("_known").isNotNull().alias("found"))
        .agg(F.count("*").alias("n"))
    )


def subwords(word: Column, low: int = 3, high: int = 6) -> Column:
    """Character n-grams of <word>, the padding signs included."""
    padded = F.concat(F.lit("<"), word, F.lit(">"))
    return F.concat(*[slices(padded, n) for n in range(low, high + 1)])


def subword_bucket(gram: Column, n_buckets: Column) -> Column:
    """Stable bucket of a sub-word: the first 7 hex digits of its md5, modulo the table size."""
    return F.conv(F.substring(F.md5(gram), 1, 7), 16, 10).cast("bigint") % n_buckets


def unseen_word_vectors(words: DataFrame, buckets: DataFrame, low: int = 3, high: int = 6) -> DataFrame:
    """(word, vector) for words without an embedding: the mean of their sub-word vectors (bucket, embedding)."""
    dims = dimensions(buckets)
    n_buckets = buckets.agg(F.count("*")).scalar()
    grams = words.select("word", F.explode(subwords(F.col("word"), low, high)).alias("gram")).select(
        "word", subword_bucket(F.col("gram"), n_buckets).alias("bucket")
    )
    cells = grams.join(buckets.select("bucket", "embedding"), "bucket").select("word", "embedding")
    return _dimension_sums(cells, "word", "embedding", dims, {"vector": lambda x: F.avg(x.cast("double"))})


def frequent_known_words(
    counts: DataFrame, embeddings: DataFrame, min_count: int, n: int | None = None, seed: int | str = 0
) -> DataFrame:
    """(word, n): words with a vector used at least min_count times; optionally a repeatable sample of them."""
    words = counts.filter(F.col("n") >= min_count).join(embeddings.select("word"), "word", "left_semi")
    return words if n is None else sample_rows(words, "word", n, seed)
