"""Documents to training tokens: quality, near duplicates, repeated passages, benchmark leaks, encoding.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's
`docs`. All but the last return the columns of `docs`. Rows with a null doc_id or text pass every stage that has no
ground to reject them; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.llm import contamination, encoding, near, quality, repeats, storage, suffixes
from textspark.llm.queries import query
from textspark.sources.tables import read_table


#: Bytes a writer of texts or token ids gathers; an executor has one writer a core.
ROW_GROUP = 16 << 20


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the discriminant, fitted on the labels of two folds of three, scores below one half."""
    labels = read_table(spark, sf_dir, "labels")
    learned = docs.filter(~quality.held_out())
    model = quality.fit(quality.features(learned), labels)
    score = storage.free_name(docs.columns, "quality")
    return quality.with_quality(docs, model, score).filter(F.col(score) >= 0.5).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near duplicates, and one of rows that repeat an id and its text."""
    groups = near.near_duplicates(docs.select("doc_id", "text"))
    gone = groups.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    again = groups.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return left
    once = left.join(again, left["doc_id"] == again["_again"], "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(again, left["doc_id"] == again["_again"], "left_anti").unionByName(once)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words and more that a smaller doc_id holds too out of the texts; no row goes."""
    # Columns named like those that the operator adds wait under other names.
    names = {c: storage.free_name(docs.columns, c) for c in docs.columns if c.lower() in repeats.ADDED}
    cut = suffixes.without_passages(docs.withColumnsRenamed(names))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*(F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold at least half of the shingles of a benchmark item."""
    name = storage.free_name(docs.columns, "matches")
    marked = contamination.with_matches(docs, read_table(spark, sf_dir, "benchmark"), name)
    return marked.filter(F.size(name) == 0).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token_ids, n_tokens, token_sha256, parity and round_trip. Written here, in batches of bounded size."""
    return storage.kept(encoding.encoded(docs), "tokens", row_group=ROW_GROUP)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each_group),
    ("suffix-array dedup", without_repeated_passages),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding", tokens),
]

#: A fitted discriminant and subword encoding have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = storage.kept_once(stage(spark, docs, sf_dir), name.replace(" ", "-"), ROW_GROUP)
    return docs
