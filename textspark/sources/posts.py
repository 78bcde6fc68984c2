"""Posts, the ledger of seen ids, dump extracts and embedding tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textspark.functions.labels import full_text, label_path

POST = T.StructType(
    [
        T.StructField("topic_id", T.LongType()),
        T.StructField("create_time", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("scrape_time", T.StringType()),
    ]
)
DUMP = "id string, url string, title string, text string"


def with_label(df: DataFrame, max_label_level: int | None = 0) -> DataFrame:
    """Replaces `labels` by a `label` path down to the given level; None keeps the array."""
    if max_label_level is None:
        return df
    return df.withColumn("label", label_path(F.col("labels"), max_label_level)).drop("labels")


def read_posts(spark: SparkSession, path: str, max_label_level: int | None = 0) -> DataFrame:
    """Posts from JSON lines, with parsed times and a `text` column of title, blank line and body."""
    posts = spark.read.schema(POST).json(path)
    times = {c: F.try_to_timestamp(c) for c in ("create_time", "scrape_time")}
    return with_label(posts.withColumns(times), max_label_level).withColumn(
        "text", full_text(F.col("title"), F.col("body"))
    )


def append_posts(posts: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Appends one batch. The ledger is a projection of this table, so no second file can fall behind."""
    posts.write.mode("append").format(file_format).save(path)


def _or_empty(read, empty: DataFrame) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return empty
        raise


def read_ledger(spark: SparkSession, posts_path: str, file_format: str = "parquet", key: str = "topic_id") -> DataFrame:
    """Ids already stored, read from the posts table itself; empty when there is none yet."""
    schema = T.StructType([T.StructField(key, T.LongType())])
    return _or_empty(
        lambda: spark.read.schema(schema).format(file_format).load(posts_path),
        spark.createDataFrame([], schema),
    )


def read_id_file(spark: SparkSession, path: str, key: str = "topic_id") -> DataFrame:
    """A text ledger of ids separated by white space; empty when absent."""
    schema = T.StructType([T.StructField(key, T.LongType())])
    return _or_empty(
        lambda: spark.read.text(path)
        .select(F.explode(F.split("value", r"\s+")).alias("id"))
        .filter(F.col("id") != "")
        .select(F.col("id").cast("bigint").alias(key)),
        spark.createDataFrame([], schema),
    )


def write_id_file(ids: DataFrame, path: str, key: str = "topic_id") -> None:
    ids.select(F.col(key).cast("string").alias("value")).write.mode("append").text(path)


def read_dump(spark: SparkSession, directory: str, file_glob: str = "wiki_*") -> DataFrame:
    """Extracted encyclopedia articles: JSON lines in nested folders."""
    return (
        spark.read.schema(DUMP)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_glob)
        .json(directory)
    )


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("word", F.col("embedding").cast("array<float>").alias("embedding"))


def parse_embedding_lines(lines: DataFrame, dims: int) -> DataFrame:
    """(word, embedding, malformed) from text lines `word v1 v2 ...`.

    A line with the wrong number of values, or a value that is no number, is marked and has no vector.
    """
    parts = F.split(F.btrim("value"), " +")
    numbers = F.transform(F.slice(F.col("_p"), 2, dims + 1), lambda x: x.try_cast("float"))
    good = (F.size("_v") == dims) & ~F.exists("_v", lambda x: x.isNull())
    return (
        lines.withColumn("_p", parts)
        .withColumn("_v", numbers)
        .select(
            F.get("_p", F.lit(0)).alias("word"),
            F.when(good, F.col("_v")).alias("embedding"),
            (~good).alias("malformed"),
        )
    )


def read_embedding_text(spark: SparkSession, path: str, dims: int) -> DataFrame:
    """Well-formed rows of a text embedding file; count the others with `parse_embedding_lines`."""
    return parse_embedding_lines(spark.read.text(path), dims).filter(~F.col("malformed")).drop("malformed")
